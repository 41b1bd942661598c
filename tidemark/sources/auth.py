"""Request signing (RSA-PSS over time, method and path), where the `cryptography` library is there."""

from __future__ import annotations

import base64
import time
from dataclasses import dataclass
from typing import Any


def load_private_key(pem_path: str) -> Any:
    from cryptography.hazmat.primitives.serialization import load_pem_private_key

    with open(pem_path, "rb") as f:
        return load_pem_private_key(f.read(), None)


@dataclass
class Signer:
    """Headers that prove a key; `prefix` names them. A key that can't travel to tasks is read where it is used, from `pem_path`."""

    key_id: str
    private_key: Any
    prefix: str = "X-ACCESS"
    pem_path: str | None = None

    def __getstate__(self) -> dict:
        return self.__dict__ | ({"private_key": None} if self.pem_path else {})

    def headers(self, method: str, path: str) -> dict[str, str]:
        if self.private_key is None:
            self.private_key = load_private_key(self.pem_path)
        from cryptography.hazmat.primitives import hashes
        from cryptography.hazmat.primitives.asymmetric import padding

        now = str(time.time_ns() // 1_000_000)
        text = f"{now}{method.upper()}{path.partition('?')[0]}".encode()
        pss = padding.PSS(padding.MGF1(hashes.SHA256()), padding.PSS.DIGEST_LENGTH)
        signature = base64.b64encode(self.private_key.sign(text, pss, hashes.SHA256())).decode()
        return {f"{self.prefix}-KEY": self.key_id, f"{self.prefix}-TIMESTAMP": now, f"{self.prefix}-SIGNATURE": signature}
