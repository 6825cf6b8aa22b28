"""Substring deduplication: repeated and nearly repeated paragraphs.

Paragraphs are the lines of a text and, so that a passage inside a longer line is found too,
the pieces between the words at which a hash of two neighbouring words is least among its
neighbours: such cuts move with the passage. Both count from MIN_WORDS words on; a piece of
fewer takes in the next one. Equal paragraphs meet in a sort by their digest. Lines also get
MinHash bands: with two rows to a band and seven bands, two lines of a Jaccard similarity of
0.75 on five-word shingles collide with a probability of 0.997. Lines that collide are compared
exactly (set_join), and the clusters are connected components. Pieces are matched exactly only:
a near copy inside a longer line is found by those of its pieces that are unchanged.

The words between a passage's edge and its first cut belong to no common piece. A paragraph is
therefore grown word by word, at most REACH words a side, for as long as its text agrees with
that of the paragraph's first occurrence; the first occurrence grows as far as any other. Runs
(paragraphs that overlap or touch) of fewer than ``least`` words are common phrases rather than
passages: a cluster is reported by its occurrences in longer runs, if it has two of them.
``least=MIN_WORDS`` reports all.
The first occurrence of a cluster stays.

Tables between the steps are deleted as soon as those derived from them are written, so that a run holds the
texts, the table of the step it is at and what later steps read.

Rows are told apart by a number given when the texts are written once, not by doc_id: repeated
rows and rows that share an id (or have none) are occurrences of their own.

Defined results: a null or empty text has no paragraphs; a repeated row repeats all its
paragraphs, and only its first row keeps them; a null doc_id comes after all others; an empty
table gives an empty result; other columns are ignored. Positions count words between ASCII
white space.
"""

from __future__ import annotations

import re
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from thermocline.llm.common import attach_group, id_and_text, tidy
from thermocline.llm.components import components
from thermocline.llm.set_join import groups_of, links, point
from thermocline.llm.shingles import WORDS, mixed, shingle_hashes, word_hashes, words_of
from thermocline.session import discard, materialize

MIN_WORDS = 8
#: Runs of repeated words that are reported, from so many words on.
MIN_PASSAGE = 25
#: Words on each side among which a cut's hash is the least.
CUT = 5
#: Words that a paragraph is grown by on each side, at most.
REACH = 32
#: Bytes of the texts that are cut together.
CHUNK = 1 << 20
BANDS, ROWS = 7, 2
_SEEDS = mixed(np.arange(1, BANDS * ROWS + 2, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_PAD = [b""] * CUT


def _cut(texts: list[str]) -> tuple[np.ndarray, ...]:
    """Paragraphs of several texts at once: hashes of all their shingles, then for each paragraph its text, where
    that text starts, its own start and end (in words of all texts) and whether it is a line. Lines come first;
    a piece that is a line too is left out."""
    words, first, size, line_text, line_words = [], [], [], [], []
    for k, text in enumerate(texts):
        lines = [line.split() for line in text.encode().lower().split(b"\n")]
        n = [len(x) for x in lines]
        first.append(len(words))
        size.append(sum(n))
        if size[-1] < MIN_WORDS:
            size[-1] = 0
            continue
        for x in lines:
            words += x
        words += _PAD
        line_text += [k] * len(n)
        line_words += n
    first, size, line_text = np.array(first, np.int64), np.array(size, np.int64), np.array(line_text, np.int64)
    held = np.flatnonzero(size)
    if not len(held):
        none = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), none, none, none, none, none.astype(bool)
    hashes = word_hashes(words)
    begin, stop = first[held], first[held] + size[held]
    # lines: running sums of their words, past the padding after each earlier text
    ends = np.cumsum(line_words) + CUT * np.searchsorted(held, line_text)
    starts = ends - line_words
    pair = np.full(len(hashes), np.iinfo(np.uint64).max)
    inside = np.ones(len(hashes), bool)
    for d in range(CUT + 1):
        inside[stop - 1 + d] = False
    pair[inside] = mixed(hashes[:-1] * np.uint64(3) + hashes[1:])[inside[:-1]]
    least = inside
    for d in range(1, CUT + 1):
        least[d:] &= pair[d:] < pair[:-d]
        least[:-d] &= pair[:-d] < pair[d:]
    cuts = np.sort(np.concatenate([begin, np.flatnonzero(least) + 1, stop]))
    last = np.isin(cuts, stop)
    at = np.flatnonzero(~last)
    short = (cuts[at + 1] - cuts[at] < MIN_WORDS) & ~last[at + 1]  # takes in the next piece, which also counts alone
    to = cuts[at + 1 + short]
    own = held[np.searchsorted(begin, cuts[at], "right") - 1]
    text, start, end = np.concatenate([line_text, own]), np.concatenate([starts, cuts[at]]), np.concatenate([ends, to])
    line = np.arange(len(start)) < len(starts)
    key = start * np.int64(len(hashes) + 1) + end
    keep = (end - start >= MIN_WORDS) & (line | ~np.isin(key, key[line]))
    text, start, end, line = text[keep], start[keep], end[keep], line[keep]
    return shingle_hashes(hashes), text, first[text], start, end, line


def paragraphs(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Shingle hashes of a text and its paragraphs: start and end (in words), whether a line."""
    shingles, _, _, start, end, line = _cut([text])
    return shingles, start, end, line


def _over(values: np.ndarray, fn: np.ufunc, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """``fn`` over the shingles of each paragraph; those that reach over its end do not count."""
    at = np.stack([start, end - WORDS + 1], axis=1).ravel()
    return fn.reduceat(np.concatenate([values, values[-1:]]), at)[::2] if len(start) else np.zeros(0, np.uint64)


def digests(shingles: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return _over(mixed(shingles ^ _SEEDS[-1]), np.add, start, end).view(np.int64)


def _band_keys(shingles: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A row of BANDS keys for each paragraph."""
    keys = np.empty((len(start), BANDS), np.uint64)
    for b in range(BANDS):
        key = np.zeros(len(start), np.uint64)
        for r in range(ROWS):
            key = mixed(key + _over(mixed(shingles ^ _SEEDS[b * ROWS + r]), np.minimum, start, end))
        keys[:, b] = key + np.uint64(b)
    return keys.view(np.int64)


def _chunks(texts: pa.Array):
    """(from, to) of rows whose texts have CHUNK bytes together, or of a longer one alone."""
    at = total = 0
    for k, n in enumerate(pc.binary_length(texts).to_pylist()):
        if k > at and total + n > CHUNK:
            yield at, k
            at, total = k, 0
        total += n
    if len(texts) > at:
        yield at, len(texts)


def _texts(docs: DataFrame) -> DataFrame:
    """row (a number), doc_id and text of every row, written once so that the numbers hold."""
    return materialize(id_and_text(docs).withColumn("row", F.monotonically_increasing_id()), "texts-numbered")


@tidy
def _paragraph_rows(batches):
    """node, row, doc_id, start, n_words, line and, for lines, band keys of every paragraph."""
    for batch in batches:
        for a, b in _chunks(batch.column("text")):
            part = batch.slice(a, b - a)
            shingles, text, first, start, end, line = _cut(part.column("text").to_pylist())
            keys = _band_keys(shingles, start[line], end[line])
            offsets = np.zeros(len(start) + 1, np.int32)
            offsets[1:] = np.cumsum(line) * BANDS
            at = pa.array(text)
            columns = [pa.array(digests(shingles, start, end), pa.int64()), part.column("row").take(at), part.column("doc_id").take(at), pa.array(start - first), pa.array((end - start).astype(np.int32)), pa.array(line)]
            columns.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys.ravel())))
            yield pa.RecordBatch.from_arrays(columns, names=["node", "row", "doc_id", "start", "n_words", "line", "keys"])


SPAN = "node long, row long, doc_id long, start long, n_words int, line boolean"


def _asked(batches):
    """From rows with a text and the spans asked for in it, of CHUNK bytes at a time: the rows, the words of all their texts,
    and for each span its row's place, the first word of its text and of the next, its node, start (in its text) and number
    of words."""
    for batch in batches:
        for a, b in _chunks(batch.column("text")):
            part = batch.slice(a, b - a)
            words, first = [], [0]
            for text in part.column("text").to_pylist():
                words += words_of(text)
                first.append(len(words))
            lists, first = part.column("spans"), np.array(first, np.int64)
            row = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy())
            spans = lists.flatten()
            yield part, words, row, first[row], first[row + 1], *[spans.field(c).to_numpy() for c in ("node", "start", "n_words")]


def _hashed(words: list[bytes], start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the words that lie in one of the ranges; 0 for all others."""
    n = len(words) + 1
    used = np.cumsum(np.bincount(start, minlength=n) - np.bincount(end, minlength=n))[:-1] > 0
    out = np.zeros(len(words), np.uint64)
    out[used] = word_hashes(list(compress(words, used.tobytes())))
    return out


@tidy
def _line_sets(batches):
    """node and elements (sorted distinct shingle hashes) of each line asked for."""
    for _, words, _, begin, _, node, start, n_words in _asked(batches):
        at = begin + start
        shingles, size = shingle_hashes(_hashed(words, at, at + n_words)), n_words.astype(np.int64) - WORDS + 1
        ends = np.cumsum(size)
        own = shingles[np.repeat(at - ends + size, size) + np.arange(size.sum())]
        for i, j in zip((ends - size).tolist(), ends.tolist(), strict=True):
            own[i:j].sort()
        fresh = np.concatenate([[True], own[1:] != own[:-1]])[: len(own)]
        fresh[ends - size] = True
        offsets = np.concatenate([[0], np.cumsum(fresh)[ends - 1]]).astype(np.int32)
        elements = pa.ListArray.from_arrays(pa.array(offsets), pa.array(own[fresh].view(np.int64)))
        yield pa.RecordBatch.from_arrays([pa.array(node), elements], names=["node", "elements"])


def _sets(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, elements) of the lines that ``wanted`` (row, spans: node, start, n_words) names."""
    return texts.join(wanted, "row").select("text", "spans").mapInArrow(_line_sets, "node long, elements array<long>")


@tidy
def _points(batches):
    for batch in batches:
        own = [x.values.to_numpy() for x in batch.column("elements")]
        columns = [batch.column("node"), pa.array([len(x) for x in own], pa.int64()), pa.array([point(x) for x in own], pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, names=["node", "n", "counts"])


@tidy
def _repeated(batches):
    """From occurrences sorted by node: all lines, and pieces whose node has another occurrence or stands at
    the edge of the task, where the other one may be in the next."""
    before = held = None  # the last node so far; the last row, while it is open whether it goes out
    for batch in batches:
        if not batch.num_rows:
            continue
        n = batch.column("node").to_numpy()
        same = np.concatenate([[before is None or n[0] == before], n[1:] == n[:-1]])
        keep = batch.column("line").to_numpy(zero_copy_only=False) | same
        keep[:-1] |= same[1:]
        if held is not None and n[0] == before:
            yield held
        held = None if keep[-1] else batch.slice(len(n) - 1)
        before = n[-1]
        yield batch.filter(pa.array(keep))
    if held is not None:
        yield held


def _with_runs(spans: DataFrame, *by: str) -> DataFrame:
    """Adds end, run_start and run_end: the run of overlapping or touching spans that a span is in, among those
    of equal ``by``, which names the row at least: a window holds paragraphs of one text."""
    before = Window.partitionBy(*by).orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy(*by).orderBy("start", "end").rowsBetween(Window.unboundedPreceding, 0)
    fresh = F.coalesce(F.col("start") > F.max("end").over(before), F.lit(True))
    runs = spans.withColumn("end", F.col("start") + F.col("n_words")).withColumn("run", fresh.cast("int")).withColumn("run", F.sum("run").over(upto))
    whole = Window.partitionBy(*by, "run")
    return runs.withColumns({"run_start": F.min("start").over(whole), "run_end": F.max("end").over(whole)}).drop("run")


def _gathered(values: np.ndarray, at: np.ndarray, step: int, n: np.ndarray) -> pa.Array:
    """For each ``at`` the bytes of the ``n`` (at most REACH) values from there on, forwards or backwards."""
    k = np.arange(REACH)
    data = values[(at[:, None] + step * k)[k < n[:, None]]]
    offsets = np.concatenate([[0], np.cumsum(values.itemsize * n)]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


@tidy
def _span_sides(batches):
    """node, row, start, n_words, left and right of each span asked for."""
    for part, words, row, begin, stop, node, start, n_words in _asked(batches):
        at, row_numbers = begin + start, part.column("row").to_numpy()[row]
        end = at + n_words
        before, after = np.minimum(start, REACH), np.minimum(stop - end, REACH)
        hashes = _hashed(words, np.concatenate([at - before, end]), np.concatenate([at, end + after]))
        hashes = (hashes >> np.uint64(32)).astype(np.uint32)
        for k in range(0, len(node), 16384):
            s = slice(k, k + 16384)
            sides = [_gathered(hashes, at[s] - 1, -1, before[s]), _gathered(hashes, end[s], 1, after[s])]
            columns = [pa.array(c[s]) for c in (node, row_numbers, start, n_words)]
            yield pa.RecordBatch.from_arrays([*columns, *sides], names=["node", "row", "start", "n_words", "left", "right"])


def _sides(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """node, row, start, n_words, left and right: 32-bit hashes of the REACH words on each side of the spans that
    ``wanted`` (row, spans) names, from the span outwards; a side that the text ends on is shorter."""
    rows = texts.join(wanted, "row").select("row", "text", "spans")
    return rows.mapInArrow(_span_sides, "node long, row long, start long, n_words int, left binary, right binary")


def _alike(one: list[bytes], two: list[bytes]) -> np.ndarray:
    """Number of words that each two sides have in common from the span outwards."""
    width = 4 * REACH + 4
    lengths = np.array([min(len(x), len(y)) for x, y in zip(one, two, strict=True)], np.int64) // 4
    flat = [np.frombuffer(b"".join(x.ljust(width, b"\0") for x in side), np.uint32).reshape(-1, REACH + 1) for side in (one, two)]
    differ = flat[0] != flat[1]
    differ[:, REACH] = True
    return np.minimum(differ.argmax(axis=1), lengths)


@tidy
def _agreement(batches):
    """For each span how far it grows on either side, 0 where it is not at that end of its run."""
    kept = ["node", "row", "start", "first_row", "first_start"]
    for batch in batches:
        for at in range(0, batch.num_rows, 2048):
            part = batch.slice(at, 2048)
            grown = []
            for side in ("left", "right"):
                open_here = part.column(f"at_{side}").to_numpy(zero_copy_only=False)
                grown.append(pa.array(np.where(open_here, _alike(part.column(side).to_pylist(), part.column(f"first_{side}").to_pylist()), 0).astype(np.int32)))
            yield pa.RecordBatch.from_arrays([*[part.column(c) for c in kept], *grown], names=[*kept, "left", "right"])


def _grown(texts: DataFrame, spans: DataFrame) -> DataFrame:
    """``spans`` (node, row, doc_id, start, n_words, cluster_id), grown as far as their text agrees with that of their
    node's first occurrence. Within a run of paragraphs that continue alike in both texts only the ends are grown."""
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row", "start"))
    firsts = spans.groupBy("node").agg(first.alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    firsts = materialize(firsts.select("node", F.col("first.row").alias("first_row"), F.col("first.start").alias("first_start")), "paragraph-firsts")
    is_first = (F.col("row") == F.col("first_row")) & (F.col("start") == F.col("first_start"))
    aligned = spans.join(firsts, "node").select("node", "row", "start", "n_words", "first_row", "first_start", (F.col("first_start") - F.col("start")).alias("shift"))
    aligned = _with_runs(aligned.where(~is_first), "row", "first_row", "shift")
    ends = aligned.select("node", "row", "start", "n_words", "first_row", "first_start", (F.col("start") == F.col("run_start")).alias("at_left"), (F.col("end") == F.col("run_end")).alias("at_right"))
    ends = materialize(ends.where("at_left OR at_right"), "paragraphs-at-ends")
    asked = ends.select("row", "node", "start", "n_words").unionByName(ends.select(F.col("first_row").alias("row"), "node", F.col("first_start").alias("start"), "n_words").distinct())
    wanted = materialize(asked.groupBy("row").agg(F.collect_list(F.struct("node", "start", "n_words")).alias("spans")), "paragraphs-to-grow")  # at most the text's paragraphs
    sides = materialize(_sides(texts, wanted), "paragraph-sides")
    of_first = sides.join(firsts, "node").where(is_first).select("node", F.col("left").alias("first_left"), F.col("right").alias("first_right"))
    pairs = ends.join(sides.drop("n_words"), ["node", "row", "start"]).join(of_first, "node")
    grown = pairs.select("node", "row", "start", "first_row", "first_start", "at_left", "at_right", "left", "right", "first_left", "first_right")
    grown = materialize(grown.mapInArrow(_agreement, "node long, row long, start long, first_row long, first_start long, left int, right int"), "paragraph-growth")
    discard(firsts, ends, wanted, sides)
    of_firsts = grown.groupBy("node", F.col("first_row").alias("row"), F.col("first_start").alias("start")).agg(F.max("left").alias("left"), F.max("right").alias("right"))
    own = grown.select("node", "row", "start", "left", "right").unionByName(of_firsts)
    left, right = F.coalesce("left", F.lit(0)), F.coalesce("right", F.lit(0))
    out = spans.join(own, ["node", "row", "start"], "left")
    return out.select("cluster_id", "row", "doc_id", (F.col("start") - left).alias("start"), (F.col("n_words") + left + right).cast("int").alias("n_words"))


def _several(spans: DataFrame) -> DataFrame:
    """The rows of ``spans`` whose cluster has another one."""
    return spans.join(spans.groupBy("cluster_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("cluster_id"), "cluster_id", "left_semi")


def _repeats(texts: DataFrame, least: int) -> DataFrame:
    """The result of repeated_paragraphs for numbered texts, with their row numbers."""
    every = materialize(texts.select("row", "doc_id", "text").mapInArrow(_paragraph_rows, f"{SPAN}, keys array<long>"), "paragraphs-all")
    dealt = every.drop("keys").repartitionByRange("node", "row", "start").sortWithinPartitions("node", "row", "start")
    found = materialize(dealt.mapInArrow(_repeated, SPAN), "paragraphs")
    groups = groups_of(every.where("line").select(F.explode("keys").alias("key"), "node"))
    discard(every)
    active = groups.select("node").distinct()
    homes = found.where("line").groupBy("node").agg(F.min(F.struct("row", "start", "n_words")).alias("at")).join(active, "node")
    wanted = homes.groupBy(F.col("at.row").alias("row")).agg(F.collect_list(F.struct("node", "at.start", "at.n_words")).alias("spans"))
    wanted = materialize(wanted, "lines-wanted")  # at most the text's lines
    sets = materialize(_sets(texts, wanted), "line-sets")
    points = materialize(sets.mapInArrow(_points, "node long, n long, counts binary"), "line-points")
    of = lambda nodes: sets.join(nodes, "node", "left_semi")
    linked = materialize(links(groups, points, of), "line-links")
    discard(wanted, sets, points)
    roots = materialize(components(linked), "line-roots")
    placed = found.join(roots, "node", "left").select(F.coalesce("root", "node").alias("cluster_id"), "node", "row", "doc_id", "start", "n_words")
    placed = materialize(placed, "paragraphs-placed")
    discard(found)
    repeated = materialize(_several(placed), "paragraphs-repeated")
    discard(placed)
    grown = _with_runs(_grown(texts, repeated), "row")
    passages = materialize(grown.where(F.col("run_end") - F.col("run_start") >= least).drop("end", "run_start", "run_end"), "passages")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row", "start"))
    out = attach_group(passages, ["cluster_id"], {"first": first, "occurrences": F.count(F.lit(1))}).where("occurrences > 1")
    here = (F.col("row") == F.col("first.row")) & (F.col("start") == F.col("first.start"))
    return out.select("row", "doc_id", F.col("start").alias("start_word"), "n_words", "cluster_id", "occurrences", F.col("first.doc_id").alias("first_doc_id"), F.col("first.start").alias("first_start_word"), (~here).alias("removed"))


def repeated_paragraphs(docs: DataFrame, least: int = MIN_PASSAGE) -> DataFrame:
    """doc_id, start_word, n_words, cluster_id, occurrences, first_doc_id, first_start_word and removed of
    every paragraph that occurs, exactly or nearly, more than once, in runs of ``least`` words or more."""
    return _repeats(_texts(docs), least).drop("row")


_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def without_words(text: str, spans: list[tuple[int, int]]) -> str:
    """``text`` without the words of ``spans`` (start, number), white space before each span kept."""
    words = [m.span() for m in _WORD.finditer(text)]
    out, at = [], 0
    for start, n in sorted(spans):
        begin, end = words[start][0], words[start + n - 1][1]
        if end > at:
            out.append(text[at : max(at, begin)])
            at = end
    return "".join(out) + text[at:]


def remove_repeats(docs: DataFrame, least: int = MIN_PASSAGE) -> DataFrame:
    """doc_id and text of every row, without the paragraphs that are removed."""
    texts = _texts(docs)
    cut = _repeats(texts, least).where("removed").groupBy("row").agg(F.collect_set(F.struct("start_word", "n_words")).alias("spans"))  # at most the text's paragraphs

    @tidy
    def run(batches):
        for batch in batches:
            rows = zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist(), strict=True)
            texts = [without_words(t, [(s["start_word"], s["n_words"]) for s in spans]) if spans else t for t, spans in rows]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return texts.join(cut, "row", "left").select("doc_id", "text", "spans").mapInArrow(run, "doc_id long, text string")
