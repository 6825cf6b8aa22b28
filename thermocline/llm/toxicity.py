"""Toxicity scores: gradient-boosted trees over dense features of a text, calibrated.

Features are rates and counts over the whole text: words of a fixed and of a learned
lexicon, the same after undoing obfuscation, lexicon words near second-person words,
capitals, punctuation, digits. The lexicon and the trees learn from labelled rows that are
not held out: at most MAX_TRAIN rows, those with the smallest hash of their id. A quarter
of these rows is kept from the trees for the isotonic calibration.

Defined results: a null or empty text has only zero features and is scored like any other;
repeated rows get equal scores; a null label or an unlabelled row is not used; several
labels of one document count as the largest; a null doc_id is held out or not by the crc32
of the empty text and never used for training; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thermocline.llm.common import id_and_text, id_crc, tidy
from thermocline.llm.trees import Scorer, boosted_trees, calibrated
from thermocline.session import materialize

#: Bound of the labelled rows that are learned from.
MAX_TRAIN = 20_000
#: Bound of the learned lexicon, whose entries are beginnings of words: invented or inflected words share them.
LEXICON_WORDS = 400
#: Least and greatest length of an entry, and its least log odds of toxic against clean documents.
STEM = (3, 9)
MIN_ODDS = 2.5
THRESHOLD = 0.7
#: Words around a second-person word within which a lexicon word is aimed at someone.
NEAR = 5

INSULTS = frozenset(
    "idiot idiots stupid moron morons loser losers scum pathetic worthless disgusting trash clown dumb fool fools ugly garbage jerk "
    "imbecile vermin filth filthy freak pig bastard coward retard dumbass crap shit fuck fucking bitch asshole "
    "dumm idioten dreck abschaum arschloch trottel widerlich imbécile crétin abruti ordure connard merde débile "
    "estúpido estúpida imbécil basura asqueroso idiota tonto mierda cabrón".split()
)
SECOND_PERSON = frozenset("you your yours yourself u ur du dich dir dein deine ihr euch tu te toi ton ta vous votre tú ti usted ustedes tus vosotros".split())
EDGES = ".,;:!?\"'()[]{}<>*_~«»„“”…-"
LEET = str.maketrans("013457@$!", "oieastasi")
#: Flags of a word.
INSULT, LEARNED, AIMED, HIDDEN, SHOUTED, MIXED = 1, 2, 4, 8, 16, 32

FEATURES = [
    "insult_rate", "insult_count", "learned_rate", "learned_count", "distinct_hits", "hidden_rate", "aimed_rate", "second_person_rate",
    "shouted_rate", "mixed_rate", "capital_share", "digit_share", "punctuation_share", "exclamation_rate", "question_rate", "length",
]


def bare(word: str) -> str:
    return word.lower().strip(EDGES)


class Words(dict):
    """Flags of words, worked out once for each distinct word (emptied when it has grown large)."""

    def __init__(self, learned: frozenset[str]):
        self.learned = learned

    def learns(self, word: str) -> bool:
        return any(word[:n] in self.learned for n in range(STEM[0], min(len(word), STEM[1]) + 1))

    def __missing__(self, word: str) -> int:
        if len(self) > 400_000:
            self.clear()
        low, flags = bare(word), 0
        if low in INSULTS:
            flags |= INSULT
        if self.learns(low):
            flags |= LEARNED
        if low in SECOND_PERSON:
            flags |= AIMED
        if not flags and len(low) > 2:
            plain = "".join(c for c in low.translate(LEET) if c.isalpha())
            if plain != low:
                if plain in INSULTS or self.learns(plain):
                    flags |= HIDDEN
                if any(c.isalpha() for c in low):
                    flags |= MIXED
        if len(word) > 2 and word.isupper():
            flags |= SHOUTED
        if len(word) <= 64:
            self[word] = flags
        return flags


_CLASSES = np.zeros(256, np.int64)
_CLASSES[65:91] = 1
_CLASSES[48:58] = 2
_CLASSES[[b for b in range(33, 127) if not chr(b).isalnum()]] = 3


def features(text: str, words: Words) -> list[float]:
    raw = text.split()
    n, chars = max(1, len(raw)), max(1, len(text))
    flags = np.fromiter(map(words.__getitem__, raw), np.int16, len(raw))
    hits = np.flatnonzero(flags & (INSULT | LEARNED | HIDDEN))
    you = np.flatnonzero(flags & AIMED)
    aimed = 0
    if len(hits) and len(you):
        k = np.searchsorted(you, hits)
        aimed = int((np.minimum(abs(you[np.minimum(k, len(you) - 1)] - hits), abs(hits - you[np.maximum(k - 1, 0)])) <= NEAR).sum())
    count = [int(np.count_nonzero(flags & f)) for f in (INSULT, LEARNED, HIDDEN, SHOUTED, MIXED)]
    # a megabyte at a time: the table lookup makes eight bytes of each
    data, kinds = np.frombuffer(text.encode(), np.uint8), np.zeros(4, np.int64)
    for at in range(0, len(data), 1 << 20):
        kinds += np.bincount(_CLASSES[data[at : at + (1 << 20)]], minlength=4)
    distinct = len({bare(raw[i]) for i in hits.tolist()})
    return [
        100 * count[0] / n, math.log1p(count[0]), 100 * count[1] / n, math.log1p(count[1]), distinct, 100 * count[2] / n, 100 * aimed / n,
        100 * len(you) / n, 100 * count[3] / n, 100 * count[4] / n, kinds[1] / chars, kinds[2] / chars, kinds[3] / chars,
        100 * text.count("!") / n, 100 * text.count("?") / n, math.log1p(len(raw)),
    ]


_WORDS: dict[frozenset, Words] = {}


def add_features(docs: DataFrame, learned: list[str], carry: list[str] = ()) -> DataFrame:
    """doc_id, the columns ``carry`` and FEATURES of rows (doc_id, text, ...)."""
    lexicon = frozenset(learned)

    @tidy
    def run(batches):
        if lexicon not in _WORDS:
            _WORDS.clear()
            _WORDS[lexicon] = Words(lexicon)
        words = _WORDS[lexicon]
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                rows = np.array([features(t.as_py() or "", words) for t in part.column("text")], float).reshape(-1, len(FEATURES))
                columns = [part.column(c) for c in ("doc_id", *carry)] + [pa.array(c) for c in rows.T]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", *carry, *FEATURES])

    kinds = dict(docs.dtypes)
    schema = ", ".join([f"`{c}` {kinds[c]}" for c in ("doc_id", *carry)] + [f"{c} double" for c in FEATURES])
    return docs.select("doc_id", "text", *carry).mapInArrow(run, schema)


def learn_lexicon(train: DataFrame) -> list[str]:
    """Beginnings of words that far more toxic than clean documents hold, at most LEXICON_WORDS of them.
    A beginning is left out if a shorter one of about the same odds is in."""

    @tidy
    def beginnings(batches):
        counts: dict[str, list[int]] = {}
        for batch in batches:
            for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist(), strict=True):
                words = set(map(bare, text.split()))
                for stem in {w[:n] for w in words for n in range(STEM[0], min(len(w), STEM[1]) + 1)}:
                    counts.setdefault(stem, [0, 0])[label] += 1
                if len(counts) > 500_000:
                    yield _counted(counts)
                    counts = {}
        yield _counted(counts)

    sizes = train.agg(F.sum("label").alias("pos"), F.sum(1 - F.col("label")).alias("neg")).first()
    pos, neg = sizes.pos or 0, sizes.neg or 0
    if not pos or not neg:
        return []
    counts = train.select("text", "label").distinct().mapInArrow(beginnings, "stem string, n long, p long").groupBy("stem").agg(F.sum("n").alias("n"), F.sum("p").alias("p"))
    odds = F.log((F.col("p") + 0.5) / (pos + 1.0)) - F.log((F.col("n") + 0.5) / (neg + 1.0))
    found = counts.withColumn("odds", odds).where((F.col("p") >= max(3, 0.01 * pos)) & (F.col("odds") > MIN_ODDS))
    chosen: dict[str, float] = {}
    for r in sorted(found.orderBy(F.col("p").desc(), "stem").limit(50 * LEXICON_WORDS).collect(), key=lambda r: (len(r.stem), r.stem)):
        if not any(chosen.get(r.stem[:n], -9.0) >= r.odds - 1 for n in range(STEM[0], len(r.stem))):
            chosen[r.stem] = r.odds
    return sorted(chosen, key=lambda w: (-chosen[w], w))[:LEXICON_WORDS]


def _counted(counts: dict[str, list[int]]) -> pa.RecordBatch:
    columns = [pa.array(list(counts), pa.string()), pa.array([x[0] for x in counts.values()], pa.int64()), pa.array([x[1] for x in counts.values()], pa.int64())]
    return pa.RecordBatch.from_arrays(columns, names=["stem", "n", "p"])


def training_rows(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> DataFrame:
    """doc_id, text, label and fold of the labelled documents to learn from."""
    known = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("label"))
    known = known.where(id_crc() % 3 != 1).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_train)
    return materialize(id_and_text(docs).join(F.broadcast(known), "doc_id"), "toxicity-train").withColumn("fold", F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(4)))


def fit(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> tuple[list[str], Scorer]:
    """Learned lexicon and calibrated scorer."""
    train = training_rows(docs, labels, max_train)
    learned = learn_lexicon(train)
    rows = materialize(add_features(train, learned, ["label", "fold"]).coalesce(4), "toxicity-features")
    return learned, calibrated(boosted_trees(rows.where("fold > 0"), FEATURES), rows.where("fold = 0"))


def score_documents(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of ``docs``."""
    learned, score = fit(docs, labels, max_train)
    out = score(add_features(id_and_text(docs), learned))
    return out.select("doc_id", (id_crc() % 3 == 1).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> DataFrame:
    """``docs`` without the rows whose score reaches THRESHOLD, all columns kept."""
    learned, score = fit(docs, labels, max_train)
    carry = {f"__in_{k}": c for k, c in enumerate(docs.columns)}
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"), *[F.col(c).alias(k) for k, c in carry.items()])
    kept = score(add_features(rows, learned, list(carry))).where(F.col("score") < THRESHOLD)
    return kept.select(*[F.col(k).alias(c) for k, c in carry.items()])
