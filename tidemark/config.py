"""Settings from the environment."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass


class ConfigError(RuntimeError):
    """A setting is missing or malformed."""


@dataclass(frozen=True)
class Config:
    data_dir: str
    key_id: str
    key_file: str
    channels: tuple[str, ...] = ("ticker", "trade")
    prefixes: tuple[str, ...] = ()
    min_free_gb: float = 5.0
    base_url: str = ""

    @property
    def raw_dir(self) -> str:
        return f"{self.data_dir}/raw"

    @property
    def parquet_dir(self) -> str:
        return f"{self.data_dir}/parquet"


def load(env: Mapping[str, str] | None = None) -> Config:
    """TIDEMARK_DATA_DIR, _KEY_ID and _KEY_FILE must be set; _CHANNELS, _PREFIXES (commas), _MIN_FREE_GB and _BASE_URL may be."""
    env = os.environ if env is None else env
    get = lambda name: env.get(f"TIDEMARK_{name}", "").strip()
    missing = [n for n in ("DATA_DIR", "KEY_ID", "KEY_FILE") if not get(n)]
    if missing:
        raise ConfigError("not set: " + ", ".join(f"TIDEMARK_{n}" for n in missing))
    listed = lambda name, other: tuple(x.strip() for x in get(name).split(",") if x.strip()) or other
    try:
        free = float(get("MIN_FREE_GB") or Config.min_free_gb)
    except ValueError:
        raise ConfigError(f"TIDEMARK_MIN_FREE_GB is no number: {get('MIN_FREE_GB')!r}") from None
    return Config(get("DATA_DIR"), get("KEY_ID"), get("KEY_FILE"), listed("CHANNELS", Config.channels), listed("PREFIXES", ()), free, get("BASE_URL").rstrip("/"))
