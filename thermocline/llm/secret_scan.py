"""Secret scan: broad candidate patterns, and a random forest that removes false positives.

Candidates are tokens that could be a credential: long runs of key characters with a digit,
values assigned to some name, each at its full length, and private keys from BEGIN to END.
Features of a whole candidate: length, character transitions, entropy, dictionary coverage,
whether it looks like a path or an address, and its neighbouring words. The dictionary is the
whole words of a public vocabulary file, whose path is a parameter; its size is that of the
file, whatever the corpus. The forest is fitted on labelled findings, at most
MAX_TRAIN of each label, chosen by hash. Where no labels are given, findings of a fixed
well-known format (provider prefixes, hex values assigned to a credential's name) count as
1, and mail and network addresses, plain numbers, paths, dates and placeholders as 0; other
findings are left to the forest. Reports hold a hash of the finding, never the finding.

Defined results: a null or empty text has no findings; every occurrence in every row is a
finding, also in repeated rows; a null doc_id is kept; an empty table gives an empty
result; other columns are ignored. Masking knows a row by its doc_id and the hash of its text, so
that rows of one doc_id, or of none, with different texts are each cut at their own findings.
"""

from __future__ import annotations

import hashlib
import json
import math
import re
from collections import Counter

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thermocline.llm.common import tidy
from thermocline.llm.trees import Scorer, random_forest
from thermocline.session import materialize

MAX_TRAIN = 5_000
THRESHOLD = 0.5
MASK = "<SECRET>"
VOCABULARY = "word_bpe_49k.json"
CREDENTIAL = r"(?:pass(?:word|wd|phrase)?|pwd|secret|token|api[_-]?key|access[_-]?key|auth|credential|private[_-]?key|client[_-]?secret)"
#: value of an assignment | run of key characters; neither is given back, so that long ones take linear time
CANDIDATE = re.compile(
    r"(?P<name>[A-Za-z_][\w.-]{1,40})[\"']?[ ]?(?:=|:=|:)[ ]?[\"']?(?P<value>[^\s\"',;]{6,}+)"
    r"|(?<![\w+/=.@:-])(?P<run>(?=[\w+/=.@:-]*\d)[\w+/=.@:-]{8,}+)",
    re.ASCII,
)
KEY_EDGE = re.compile(r"-----(?P<edge>BEGIN|END) [A-Z ]{0,30}PRIVATE KEY(?: BLOCK)?-----")
#: What follows a header without an END: lines of key characters, also with escaped line ends.
KEY_LINES = re.compile(r"(?:(?:\s|\\[nr])++[A-Za-z0-9+/=]{32,}+)*+")
PREFIXED = re.compile(r"(?:AKIA|ASIA)[0-9A-Z]{16}$|gh[pousr]_\w{36,}$|xox[abprs]-[\w-]{10,}$|sk_live_\w{16,}$|AIza[\w-]{35}$|eyJ[\w-]{10,}\.eyJ[\w-]{10,}\.|-----BEGIN", re.ASCII)
NAMED = re.compile(CREDENTIAL, re.I | re.ASCII)
HEX = re.compile(r"[0-9a-f]{16,64}$", re.I | re.ASCII)
HARMLESS = re.compile(
    r"[\w.+-]+@[\w-]+(?:\.[\w-]+)+\.?$|\+?[\d.,:/() -]+$|\w+://|(?:[\w.-]*/){2,}|.*(?:example|sample|dummy|changeme|placeholder|xxxx|\*\*\*|your[_-])", re.I | re.ASCII
)
WORD = re.compile(r"[A-Za-z]{2,}", re.ASCII)
#: Words inside a candidate: also the parts of a name like getUserName.
PART = re.compile(r"[A-Z]?[a-z]{2,}|[A-Z]{3,}(?![a-z])", re.ASCII)
FEATURES = [
    "length", "transitions", "case_changes", "digit_ratio", "upper_ratio", "symbol_ratio", "entropy", "distinct_ratio", "hex_ratio", "vowel_ratio", "coverage", "repeated_near",
    "slashes", "dots", "has_at", "colons", "assigned", "named", "near_named", "quoted", "header", "prose_before", "prose_after",
]
KINDS = {c: 0 for c in "abcdefghijklmnopqrstuvwxyz"} | {c: 1 for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"} | {c: 2 for c in "0123456789"}


def dictionary(path: str) -> frozenset[str]:
    """Whole words of three letters or more of a vocabulary file of word pieces."""
    with open(path, encoding="utf-8") as f:
        pieces = json.load(f)["model"]["vocab"]
    words = (p.removesuffix("</w>") for p in pieces if p.endswith("</w>"))
    return frozenset(w for w in words if len(w) > 2 and w.isascii() and w.isalpha())


def _features(value: str, name: str, header: bool, text: str, start: int, end: int, known: frozenset[str]) -> list[float]:
    n, kinds = len(value), [KINDS.get(c, 3) for c in value]
    changes = sum(a != b for a, b in zip(kinds, kinds[1:], strict=False))
    cases = sum({a, b} == {0, 1} for a, b in zip(kinds, kinds[1:], strict=False))
    counts = Counter(value)
    before, after = text[max(0, start - 60) : start], text[end : end + 60]
    near = set(WORD.findall(before.lower())) | set(WORD.findall(after.lower()))
    covered = sum(len(w) for w in PART.findall(value) if w.lower() in known)
    repeated = sum(len(w) for w in WORD.findall(value.lower()) if w in near)
    words = lambda s: sum(w.isalpha() for w in s.split()) / max(1, len(s.split()))
    return [
        n, changes / max(1, n - 1), cases / max(1, n - 1), kinds.count(2) / n, kinds.count(1) / n, kinds.count(3) / n,
        -sum(c / n * math.log2(c / n) for c in counts.values()), len(counts) / n, sum(c in "0123456789abcdefABCDEF" for c in value) / n,
        sum(c in "aeiouAEIOU" for c in value) / n, covered / n, repeated / n, value.count("/"), value.count("."), float("@" in value), value.count(":"), float(bool(name)),
        float(bool(NAMED.search(name))), float(bool(NAMED.search(before))), float(before[-1:] in "\"'" and bool(before)), float(header), words(before), words(after),
    ]


def _key_blocks(text: str):
    """(start, end) of each private key, from its header to its footer or, where another or no header follows, its last line."""
    edges = list(KEY_EDGE.finditer(text))
    for k, m in enumerate(edges):
        if m["edge"] == "BEGIN":
            closed = k + 1 < len(edges) and edges[k + 1]["edge"] == "END"
            yield m.start(), edges[k + 1].end() if closed else KEY_LINES.match(text, m.end()).end()


def candidates_of(text: str):
    """(start, end, value, name, is a private key) of each candidate."""
    at = 0
    for start, end in [*_key_blocks(text), (len(text), None)]:
        for m in CANDIDATE.finditer(text[at:start] if at or end else text):
            kind = "value" if m["value"] else "run"
            yield at + m.start(kind), at + m.end(kind), m[kind], m["name"] or "", False
        if end:
            yield start, end, text[start:end], "", True
            at = end


def labelled_by_format(value: str, name: str) -> int | None:
    if HARMLESS.match(value):
        return 0
    if PREFIXED.match(value) or NAMED.search(name) and HEX.match(value):
        return 1
    return 0 if value.isalpha() else None


def find_candidates(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """doc_id, hash of the text, start and length (in characters), secret_sha256, label (by format, or null) and FEATURES
    of every candidate; ``vocabulary`` is the path of the dictionary's file."""
    known = docs.sparkSession.sparkContext.broadcast(dictionary(vocabulary or public_tokenizers.path(VOCABULARY)))
    kinds = [("doc_id", pa.int64()), ("text_hash", pa.int64()), ("start", pa.int64()), ("length_chars", pa.int64()), ("secret_sha256", pa.string()), ("label", pa.int32()), *((f, pa.float64()) for f in FEATURES)]

    @tidy
    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part, out = batch.slice(at, 256), []
                for i, row, text in zip(*[part.column(c).to_pylist() for c in ("doc_id", "text_hash", "text")], strict=True):
                    for start, end, value, name, header in candidates_of(text or ""):
                        digest = hashlib.sha256(value.encode()).hexdigest()
                        out.append((i, row, start, end - start, digest, labelled_by_format(value, name), *_features(value, name, header, text, start, end, known.value)))
                columns = zip(*out, strict=True) if out else [[] for _ in kinds]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, (_, k) in zip(columns, kinds, strict=True)], names=[n for n, _ in kinds])

    schema = "doc_id long, text_hash long, start long, length_chars long, secret_sha256 string, label int, " + ", ".join(f"{f} double" for f in FEATURES)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text").mapInArrow(run, schema)


def fit(found: DataFrame, labelled: DataFrame | None = None, max_train: int = MAX_TRAIN) -> Scorer:
    """Forest from findings: of their label by format, or of ``labelled`` (secret_sha256, label)."""
    if labelled is not None:
        own = labelled.where(F.col("label").isin(0, 1)).groupBy("secret_sha256").agg(F.max("label").cast("int").alias("label"))
        found = found.drop("label").join(own, "secret_sha256")
    distinct = found.where("label is not null").dropDuplicates(["secret_sha256"])
    mixed = [distinct.where(F.col("label") == x).orderBy(F.xxhash64("secret_sha256"), "secret_sha256").limit(max_train) for x in (0, 1)]
    return random_forest(materialize(mixed[0].unionByName(mixed[1]).coalesce(4), "secret-train"), FEATURES)


def _scored(docs: DataFrame, labelled: DataFrame | None, max_train: int, vocabulary: str | None) -> DataFrame:
    found = materialize(find_candidates(docs, vocabulary), "secret-candidates")
    return fit(found, labelled, max_train)(found).withColumn("is_secret", F.col("score") >= THRESHOLD)


def scan(docs: DataFrame, labelled: DataFrame | None = None, max_train: int = MAX_TRAIN, vocabulary: str | None = None) -> DataFrame:
    """doc_id, start, length, secret_sha256, score and is_secret of every candidate."""
    return _scored(docs, labelled, max_train, vocabulary).select("doc_id", "start", F.col("length_chars").alias("length"), "secret_sha256", "score", "is_secret")


def mask_secrets(docs: DataFrame, labelled: DataFrame | None = None, max_train: int = MAX_TRAIN, vocabulary: str | None = None) -> DataFrame:
    """``docs`` with every secret in ``text`` replaced by MASK and n_chars brought up to date; no row goes.
    Secrets are few against texts; their spans are joined to the rows by doc_id and the hash of the text, so that a
    span list is that of one text, whatever number of rows has its doc_id or none."""
    keys = ["doc_id", "text_hash"]
    spans = _scored(docs, labelled, max_train, vocabulary).where("is_secret").select(*keys, "start", F.col("length_chars").alias("length"), "secret_sha256").distinct()
    hit = spans.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("start", "length", "secret_sha256"))).alias("__spans"))
    hit = hit.withColumnsRenamed({"doc_id": "__id", "text_hash": "__text"})
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("__id")) & (F.xxhash64("text") == F.col("__text"))
    joined = docs.join(hit, same, "left").drop("__id", "__text")
    names = docs.columns
    at = names.index("text")

    @tidy
    def run(batches):
        for batch in batches:
            texts, marked = batch.column(at).to_pylist(), batch.column(batch.num_columns - 1).to_pylist()
            new = pa.array([_masked(t, s) if s else t for t, s in zip(texts, marked, strict=True)], pa.string())
            columns = [new if k == at else batch.column(k) for k in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    out = joined.mapInArrow(run, docs.schema)
    if "n_chars" in docs.columns:
        kind = dict(docs.dtypes)["n_chars"]
        out = out.withColumn("n_chars", F.when(F.col("text").contains(MASK), F.length("text")).otherwise(F.col("n_chars")).cast(kind))
    return out


def _masked(text: str | None, spans: list[dict]) -> str | None:
    out, at = [], 0
    for s in spans:
        start, end = s["start"], s["start"] + s["length"]
        if text is not None and start >= at and hashlib.sha256(text[start:end].encode()).hexdigest() == s["secret_sha256"]:
            out += [text[at:start], MASK]
            at = end
    return text if not at else "".join(out) + text[at:]
