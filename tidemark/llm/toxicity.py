"""Toxicity (1): a weighted finite-state pattern grammar over clauses.

Five transducers read the word classes of a clause: insults, threats, targets, negation and reported speech. Each is a
table (state, class) -> (state, mark), and each mark has a weight. Their composition is one table over tuples of states,
built once (`compose`). Run over a clause, it gives each insult or threat the marks of all five: what it is, whether a
target stands near it on either side (a target behind it marks it late), whether it is negated, whether it is reported. A
threat at nobody ("they kill time") is no match. A match is worth its arc times the weights of its marks; a document is
scored by what its matched clauses hold in all, in a hundred words, and in the heaviest clause.

Arcs are labelled by words and by word beginnings of `STEMS` bytes. Some are given (`SEED`) and keep their class; the others
are learned, in two passes over all training rows:

1. Document frequencies by label: an arc whose frequency among toxic rows can't be chance (Chernoff bound below `ERROR` over
   all arcs tried) is an insult, weighted by its log-odds.
2. Contexts of matches: an insult arc that is mostly followed by a target is a threat. A word that stands beside
   matches more often than chance explains is a target. A word before matches whose rows are toxic less often than
   chance explains is a negation if it mostly stands within its reach, else a report.

All arcs that pass are used. They are sent to tasks in blocks of `BLOCK_ARCS`; with more than one block, each leaves its marks
on the rows for the next. The weights of the marks are fitted to at most `SAMPLE` training rows, with `PRIOR` as the
centre of a Gaussian prior.

Defined results: null, empty and unmatched texts get the score of no evidence; rows with the same or no id are scored
each by itself (null ids never train); an id labelled twice is toxic if any label says so, null labels are none; other
columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import UID, Words, buffers, is_delimiter, keyed, materialize, mix, slices, span_hashes, table, tidy, tune

FOLDS, SAMPLE, ERROR = 5, 20_000, 0.01
STEMS = (4, 5, 6)
#: Learned arcs (17 bytes each) that are sent to tasks at once; labels (50 bytes each) that are broadcast rather than shuffled.
BLOCK_ARCS, MOST_BROADCAST_LABELS = 200_000, 250_000
#: The least difference in log-odds and the least rows of a learned arc.
LEAST_ODDS, LEAST_ROWS = 1.5, 4
SEED_WEIGHT = 4.0
#: Words are runs of letters and non-ASCII bytes; clauses end at these bytes.
NO_LETTER = is_delimiter(range(0, 65), range(91, 97), range(123, 128))
CLAUSE_END = is_delimiter(*b".!?;\n")

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT = range(6)
SEED = {
    INSULT: "idiot idiots moron morons stupid dumb loser losers pathetic worthless scum trash clown disgusting imbecile trottel dummkopf imbécile stupide idiote idiota estúpido imbécil",
    THREAT: "kill hurt destroy murder strangle stab umbringen töten tuer matar",
    TARGET: "you your yours yourself u he she they them him her du dich dir ihr euch sie tu toi vous il elle ils tú ti usted él ella ellos",
    NEGATION: "not no never none nobody isn aren wasn don doesn nicht kein keine nie niemals pas jamais aucun nunca ningún ni",
    REPORT: "said says say told tells wrote writes claimed quoted reported sagte sagt meinte dit disait écrit dijo dice escribió",
}
SEED_CLASS = {w: c for c, words in SEED.items() for w in words.split()}
#: How far negation and aim reach, in words, and what counts as standing beside a match.
REACH, AIM, BESIDE = 3, 4, 2
MARKS = ("insult", "threat", "aimed", "negated", "reported")
#: What the model sees: the arcs of matches by mark, of all matches in a hundred words, and of the heaviest clause, as logarithms.
FEATURES = (*MARKS, "density", "heaviest")
PRIOR = np.array([-5.0, 1.8, 2.2, 0.5, -1.0, -1.0, 0.8, 1.0])
PRIOR_PRECISION = 0.5
STEM_DOMAIN = np.uint64(0x2545F4914F6CDD1D)

# --- the grammar ----------------------------------------------------------------------------

#: Transducers: (state, class) -> (next state, mark). What isn't named keeps the state that `None` leads to, without a mark.
Transducer = dict[object, dict[int | None, tuple[object, str | None]]]
INSULTING: Transducer = {0: {INSULT: (0, "insult"), None: (0, None)}}
THREATENING: Transducer = {0: {THREAT: (0, "threat"), None: (0, None)}}
NEGATING: Transducer = {s: {NEGATION: (REACH, None), **{c: (max(0, s - 1), "negated" if s else None) for c in (INSULT, THREAT)}, None: (max(0, s - 1), None)} for s in range(REACH + 1)}
REPORTING: Transducer = {s: {REPORT: (1, None), **{c: (s, "reported" if s else None) for c in (INSULT, THREAT)}, None: (s, None)} for s in range(2)}
#: States: for how many words a target still aims, and for how many a match still waits for one.
AIMING: Transducer = {
    (t, p): {
        TARGET: ((AIM, 0), "aims" if p else None),
        **{c: ((max(0, t - 1), AIM if not t else max(0, p - 1)), "aimed" if t else None) for c in (INSULT, THREAT)},
        None: ((max(0, t - 1), max(0, p - 1)), None),
    }
    for t in range(AIM + 1)
    for p in range(AIM + 1)
}


def compose(*parts: Transducer) -> tuple[list[list[int]], list[list[frozenset[str]]], int]:
    """The product of transducers: tables state x class -> state and -> marks, and the start."""
    states = list(itertools.product(*parts))
    number = {s: i for i, s in enumerate(states)}
    step, marks = [], []
    for state in states:
        arcs = [[p[x].get(c, p[x][None]) for p, x in zip(parts, state)] for c in range(6)]
        step.append([number[tuple(to for to, _ in a)] for a in arcs])
        marks.append([frozenset(m for _, m in a if m) for a in arcs])
    return step, marks, number[tuple(next(iter(p)) for p in parts)]


STEP, MARKED, START = compose(INSULTING, THREATENING, AIMING, NEGATING, REPORTING)


def clause_matches(classes: list[int]) -> list[tuple[int, frozenset[str]]]:
    """(word, marks) of a clause's matches."""
    state, found, waiting = START, [], []
    for i, c in enumerate(classes):
        marks = MARKED[state][c]
        if c in (INSULT, THREAT):
            found.append((i, marks))
            if "aimed" not in marks:
                waiting.append(len(found) - 1)
        elif "aims" in marks:
            for k in waiting:
                if i - found[k][0] <= AIM:
                    found[k] = (found[k][0], found[k][1] | {"aimed"})
            waiting = []
        state = STEP[state][c]
    return [(i, marks) for i, marks in found if "threat" not in marks or "aimed" in marks]


# --- arcs -----------------------------------------------------------------------------------


@dataclass(frozen=True)
class Arcs:
    """Labels in order, with the class and weight of each."""

    label: np.ndarray
    kind: np.ndarray
    weight: np.ndarray

    def at(self, h: np.ndarray) -> np.ndarray:
        """The place of each label, or -1."""
        if not len(self.label):
            return np.full(len(h), -1)
        at = np.minimum(np.searchsorted(self.label, h), len(self.label) - 1)
        return np.where(self.label[at] == h, at, -1)

    @staticmethod
    def of(label: np.ndarray, kind: np.ndarray, weight: np.ndarray) -> Arcs:
        order = np.argsort(label)
        return Arcs(label[order], kind[order].astype(np.int64), weight[order].astype(float))


def word_arcs(w: Words) -> list[np.ndarray]:
    """Labels of each word's arcs: the whole word, and its beginnings (0: none, as the word is too short)."""
    size = w.end - w.start
    out = [w.hashes()]
    for n in STEMS:
        long = np.flatnonzero(size > n)
        h = np.zeros(len(w), np.uint64)
        h[long] = mix(span_hashes(w.data, w.start[long], w.start[long] + n) + STEM_DOMAIN)
        out.append(h)
    return out


def _letters(data: np.ndarray, offsets: np.ndarray) -> Words:
    return Words(data, offsets, NO_LETTER, lower=True)


def seed_arcs() -> Arcs:
    names = list(SEED_CLASS)
    kind = np.array([SEED_CLASS[x] for x in names])
    return Arcs.of(_letters(*buffers(pa.array(names))).hashes(), kind, np.where((kind == INSULT) | (kind == THREAT), SEED_WEIGHT, 0.0))


class Text:
    """Words of some texts with their arcs, classes and weights, and the clauses' word ranges."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, seeds: Arcs):
        self.words = w = _letters(data, offsets)
        self.owner = w.owner()
        self.arcs = word_arcs(w)
        at = seeds.at(self.arcs[0])
        self.seeded = at >= 0
        self.kind = np.where(self.seeded, seeds.kind[np.maximum(at, 0)], OTHER)
        self.weight = np.where(self.seeded, seeds.weight[np.maximum(at, 0)], 0.0)
        clause = np.cumsum(CLAUSE_END[data])[w.start] if len(w) else np.zeros(0, np.int64)
        self.starts = np.flatnonzero(np.concatenate(([True], (clause[1:] != clause[:-1]) | (self.owner[1:] != self.owner[:-1])))) if len(w) else np.zeros(0, np.int64)

    def learn(self, arcs: Arcs) -> None:
        """Take in learned arcs: of a word's arcs the heaviest counts; seed words keep what they are."""
        for h in self.arcs:
            at = arcs.at(h)
            weight = np.where(at >= 0, arcs.weight[np.maximum(at, 0)] if len(arcs.label) else 0.0, 0.0)
            better = ~self.seeded & (weight > self.weight)
            self.kind[better], self.weight[better] = arcs.kind[at[better]], weight[better]

    def clauses(self) -> Iterator[tuple[int, int]]:
        """Word ranges of clauses that hold an insult or a threat."""
        hits = np.flatnonzero((self.kind == INSULT) | (self.kind == THREAT))
        which = np.unique(np.searchsorted(self.starts, hits, "right") - 1)
        return zip(self.starts[which].tolist(), np.append(self.starts[1:], len(self.words))[which].tolist())


def _once(label: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Places of each (label, text) once."""
    order = np.lexsort((owner, label))
    a, o = label[order], owner[order]
    return order[np.concatenate(([True], (a[1:] != a[:-1]) | (o[1:] != o[:-1])))] if len(a) else order


COUNTED = ("pos", "neg", "followed", "beside", "near_pos", "near_neg", "far_pos", "far_neg")


def _counts(rows: DataFrame, columns: int, count) -> DataFrame:
    """Sums by arc of what `count` finds in labelled rows (text, toxic): (labels, matrix of columns); tasks add up first."""
    names = ["arc", *COUNTED[:columns]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        n = 0

        def flush() -> Iterator[pa.RecordBatch]:
            arc, inverse = np.unique(np.concatenate([a for a, _ in held]), return_inverse=True)
            all_ = np.concatenate([b for _, b in held])
            sums = [np.bincount(inverse, all_[:, k], len(arc)).astype(np.int64) for k in range(columns)]
            for i in range(0, len(arc), 1 << 16):
                s = slice(i, i + (1 << 16))
                yield pa.record_batch([pa.array(arc[s].view(np.int64)), *(pa.array(x[s]) for x in sums)], names)

        seeds = seed_arcs()
        for batch in batches:
            data, offsets = buffers(batch.column("text"))
            toxic = batch.column("toxic").to_numpy()
            for i, j in slices(offsets):
                text = Text(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], seeds)
                for labels, values in count(text, toxic[i:j]):
                    held.append((labels, values))
                    n += len(labels)
            if n >= 1_000_000:
                yield from flush()
                held, n = [], 0
        if held:
            yield from flush()

    out = rows.select("text", "toxic").mapInArrow(tidy(run), ", ".join(f"{c} long" for c in names))
    return out.groupBy("arc").agg(*[F.sum(c).alias(c) for c in names[1:]])


def arc_counts(rows: DataFrame) -> DataFrame:
    """(arc, pos, neg): in how many toxic and other rows each arc occurs."""

    def count(text: Text, toxic: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for h in text.arcs:
            ok = np.flatnonzero(h)
            one = ok[_once(h[ok], text.owner[ok])]
            y = toxic[text.owner[one]]
            yield h[one], np.stack([y, 1 - y], axis=1)

    return _counts(rows, 2, count)


def context_counts(rows: DataFrame, arcs: Arcs) -> DataFrame:
    """`COUNTED` by arc: of matches' arcs, in how many toxic rows one is followed by a target; of other whole words, in how many
    rows one stands beside a match (toxic rows), or before one in its clause, within the reach of negation or not."""
    sent = rows.sparkSession.sparkContext.broadcast(arcs)

    def count(text: Text, toxic: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        text.learn(sent.value)
        found: dict[tuple[int, int, int], None] = {}  # (column, word, text)
        for a, b in text.clauses():
            kind = text.kind[a:b].tolist()
            y = int(toxic[text.owner[a]])
            for i in [i for i, c in enumerate(kind) if c in (INSULT, THREAT)]:
                if y and TARGET in kind[i + 1 : i + 1 + BESIDE]:
                    for h in text.arcs:
                        if h[a + i]:
                            found[2, int(h[a + i]), int(text.owner[a])] = None
                for k, c in enumerate(kind):
                    if c == OTHER:
                        h = int(text.arcs[0][a + k])
                        if y and abs(k - i) <= BESIDE:
                            found[3, h, int(text.owner[a])] = None
                        if k < i:
                            found[(4 if i - k <= REACH else 6) + 1 - y, h, int(text.owner[a])] = None
        if found:
            values = np.zeros((len(found), len(COUNTED)), np.int64)
            values[np.arange(len(found)), [c for c, *_ in found]] = 1
            yield np.array([h for _, h, _ in found], np.uint64), values

    return _counts(rows, len(COUNTED), count)


def _divergence(n: Column, q: Column, p: Column | float) -> Column:
    """n times the divergence of a share q from p: minus the logarithm of Chernoff's bound."""
    p = p if isinstance(p, Column) else F.lit(float(p))
    part = lambda a, b: F.when(a > 0, a * F.log(a / b)).otherwise(0.0)
    return n * (part(q, p) + part(1 - q, 1 - p))


def _odds(a: Column, of_a: Column | float, b: Column, of_b: Column | float) -> Column:
    """Difference in log-frequency."""
    return F.log((a + 0.5) / (of_a + 1.0)) - F.log((b + 0.5) / (of_b + 1.0))


def learn_arcs(rows: DataFrame) -> DataFrame:
    """(arc, kind, weight) that labelled rows (text, toxic) support, as a written table."""
    spark = rows.sparkSession
    none = spark.createDataFrame([], "arc long, kind int, weight double")
    totals = rows.agg(F.sum("toxic").alias("p"), F.count("*").alias("n")).first()
    toxic, every = totals["p"] or 0, totals["n"]
    if not 0 < toxic < every:
        return none
    counts = materialize(arc_counts(rows).filter(F.col("pos") >= LEAST_ROWS))
    n = F.col("pos") + F.col("neg")
    odds = _odds(F.col("pos"), F.lit(toxic), F.col("neg"), F.lit(every - toxic))
    tried = max(1, counts.count())
    bound = _divergence(n, F.col("pos") / n, toxic / every)
    insults = counts.withColumn("weight", odds).filter((odds >= LEAST_ODDS) & (F.col("pos") / n > toxic / every) & (bound >= math.log(tried / ERROR)))
    insults = materialize(insults.select("arc", "pos", F.lit(INSULT).alias("kind"), "weight"))
    contexts = [materialize(context_counts(rows, block)) for block in arc_blocks(insults)]  # nearly always one
    if not contexts:
        return none
    context = contexts[0]
    for more in contexts[1:]:
        context = context.unionByName(more)
    context = materialize(context.groupBy("arc").agg(*[F.sum(c).alias(c) for c in COUNTED[2:]]))
    aimed = context.select("arc", "followed")
    hits = insults.join(aimed, "arc", "left").select("arc", F.when(2 * F.coalesce("followed", F.lit(0)) >= F.col("pos"), THREAT).otherwise(INSULT).alias("kind"), "weight")
    # words around matches; arcs of the first pass are no context
    around = materialize(context.join(counts.select("arc", "pos"), "arc", "left").join(insults.select("arc"), "arc", "left_anti"))
    sums = around.agg(*[F.sum(c).alias(c) for c in (*COUNTED[3:], "pos")], F.count("*").alias("tried")).first()
    least = math.log(max(1, sums["tried"]) / ERROR)
    before, toxic_before = F.col("near_pos") + F.col("near_neg") + F.col("far_pos") + F.col("far_neg"), F.col("near_pos") + F.col("far_pos")
    toxic_share, beside_share = toxic_before / F.greatest(before, F.lit(1)), F.col("beside") / F.greatest(F.col("pos"), F.lit(1))
    all_before, beside = sum(sums[c] or 0 for c in COUNTED[4:]), (sums["beside"] or 0) / max(1, sums["pos"] or 0)
    share = ((sums["near_pos"] or 0) + (sums["far_pos"] or 0)) / max(1, all_before)
    inner = lambda x: min(max(x, 1e-9), 1 - 1e-9)
    is_target = (F.col("pos") >= LEAST_ROWS) & (F.log(beside_share / inner(beside)) >= LEAST_ODDS) & (_divergence(F.col("pos"), beside_share, inner(beside)) >= least)
    is_excuse = (before - toxic_before >= LEAST_ROWS) & (toxic_share < share) & (_divergence(before, toxic_share, inner(share)) >= least)
    nearly = F.col("near_pos") + F.col("near_neg") >= F.col("far_pos") + F.col("far_neg")
    kind = F.when(F.coalesce(is_excuse, F.lit(False)), F.when(nearly, NEGATION).otherwise(REPORT)).when(F.coalesce(is_target, F.lit(False)), TARGET)
    words = around.filter(before + F.col("beside") > 0).select("arc", kind.alias("kind"), F.lit(1e-6).alias("weight")).filter("kind is not null")
    return materialize(hits.unionByName(words))


def arc_blocks(arcs: DataFrame, most: int = BLOCK_ARCS) -> Iterator[Arcs]:
    """A table of arcs in blocks of about `most`, parted by hashes of their labels."""
    parts = -(-arcs.count() // most)
    for k in range(parts):
        found = arcs.filter(F.pmod(F.xxhash64("arc"), F.lit(parts)) == k).select("arc", "kind", "weight").toArrow()
        yield Arcs.of(found.column(0).to_numpy().view(np.uint64), found.column(1).to_numpy(), found.column(2).to_numpy())


# --- scores ---------------------------------------------------------------------------------

EVIDENCE = ", ".join([f"{UID} long", "doc_id long", *(f"{k} double" for k in FEATURES)])
NOTE = np.dtype([("word", "<u4"), ("kind", "u1"), ("weight", "<f8")])


def evidence(rows: DataFrame, arcs: Iterator[Arcs]) -> DataFrame:
    """`EVIDENCE` of every text."""
    blocks = list(itertools.islice(arcs, 1)) or [Arcs.of(np.zeros(0, np.uint64), np.zeros(0), np.zeros(0))]
    rows = rows.select(UID, "doc_id", "text")
    for block in arcs:  # the last block scores; those before it leave notes
        rows = _noted(rows, blocks.pop())
        blocks.append(block)
    sent = rows.sparkSession.sparkContext.broadcast(blocks[0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seeds = seed_arcs()
        for batch, part, text in _texts(batches, seeds):
            text.learn(sent.value)
            out = np.zeros((part.num_rows, len(FEATURES)))
            for a, b in text.clauses():
                d, clause = text.owner[a], 0.0
                for i, marks in clause_matches(text.kind[a:b].tolist()):
                    weight = text.weight[a + i]
                    clause += weight
                    for m in marks:
                        out[d, MARKS.index(m)] += weight
                out[d, -1] = max(out[d, -1], clause)
            out[:, -2] = 100 * out[:, :2].sum(axis=1) / np.maximum(text.words.count, 20)
            yield pa.record_batch([part.column(UID), part.column("doc_id"), *(pa.array(c) for c in np.log1p(out).T)], [UID, "doc_id", *FEATURES])

    return rows.mapInArrow(tidy(run), EVIDENCE)


def _texts(batches: Iterator[pa.RecordBatch], seeds: Arcs) -> Iterator[tuple[pa.RecordBatch, pa.RecordBatch, Text]]:
    """Slices of batches with their words, and what notes of earlier blocks say of them."""
    for batch in batches:
        data, offsets = buffers(batch.column("text"))
        for i, j in slices(offsets):
            part = batch.slice(i, j - i)
            text = Text(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], seeds)
            if "notes" in batch.schema.names:
                for first, notes in zip(text.words.first, part.column("notes").to_pylist()):
                    n = np.frombuffer(notes, NOTE)
                    text.kind[first + n["word"].astype(np.int64)], text.weight[first + n["word"].astype(np.int64)] = n["kind"], n["weight"]
            yield batch, part, text


def _noted(rows: DataFrame, arcs: Arcs) -> DataFrame:
    """Rows with `notes`: the words that this block's arcs or those before it give a class."""
    sent = rows.sparkSession.sparkContext.broadcast(arcs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, part, text in _texts(batches, seed_arcs()):
            text.learn(sent.value)
            at = np.flatnonzero(~text.seeded & (text.weight > 0))
            notes = np.empty(len(at), NOTE)
            notes["word"], notes["kind"], notes["weight"] = at - text.words.first[:-1][text.owner[at]], text.kind[at], text.weight[at]
            edges = np.searchsorted(text.owner[at], np.arange(part.num_rows + 1))
            yield pa.record_batch([part.column(UID), part.column("doc_id"), part.column("text"), pa.array([notes[a:b].tobytes() for a, b in zip(edges[:-1], edges[1:])], pa.binary())], [UID, "doc_id", "text", "notes"])

    return rows.mapInArrow(tidy(run), f"{UID} long, doc_id long, text string, notes binary")


def fit(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Coefficients (bias first) of a logistic model, by Newton steps under the prior."""
    x = np.hstack([np.ones((len(x), 1)), x])
    loss = lambda w: np.logaddexp(0, x @ w).sum() - y @ (x @ w) + PRIOR_PRECISION / 2 * ((w - PRIOR) ** 2).sum()
    w, now = PRIOR.copy(), loss(PRIOR)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) + PRIOR_PRECISION * (w - PRIOR)
        hessian = (x * (p * (1 - p))[:, None]).T @ x + PRIOR_PRECISION * np.eye(len(w))
        step, size = np.linalg.solve(hessian, gradient), 1.0
        while loss(w - size * step) > now and size > 1e-6:
            size /= 2
        w, before, now = w - size * step, now, loss(w - size * step)
        if before - now < 1e-9 * max(1.0, abs(now)):
            break
    return w


def held_out() -> Column:
    """Rows whose labels are never read."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % FOLDS == 0, F.lit(False))


def toxicity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row, doc_id, held_out, score, predicted, the evidence) of every text."""
    tune(docs.sparkSession)
    rows = keyed(docs, id_col, text_col)
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).dropna().filter(~held_out()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = materialize(known)
    few = known.count() <= MOST_BROADCAST_LABELS
    arcs = learn_arcs(rows.select("doc_id", "text").join(F.broadcast(known) if few else known, "doc_id"))
    found = materialize(evidence(rows, arc_blocks(arcs)))
    drawn = known.orderBy(F.xxhash64("doc_id")).limit(sample)
    taken = found.join(drawn, "doc_id").select(*FEATURES, "toxic").toArrow()  # at most `sample` ids
    w = PRIOR
    if taken.num_rows:
        w = fit(np.stack([taken.column(k).to_numpy() for k in FEATURES], axis=1), taken.column("toxic").to_numpy().astype(float))
    logit = F.lit(float(w[0]))
    for k, c in zip(FEATURES, w[1:]):
        logit = logit + F.col(k) * F.lit(float(c))
    scored = found.withColumn("score", 1 / (1 + F.exp(-logit)))
    return scored.select(UID, "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), *FEATURES)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query: score every document."""
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).select("doc_id", "held_out", "score", "predicted")
