"""Alignment of two tokenizers over the bytes of texts, with corpus counts of token pairs.

Two tokens are linked where their byte ranges overlap.  A first pass over the documents gathers
the linked id pairs; the distinct pairs get numbers by a minimal perfect hash, and their
document counts are dense vectors indexed by it, summed in a tree.  A second pass aligns the
documents again and looks the counts up, each verified by its key.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldgauge.llm.perfect_hash import PerfectHash, perfect_hash
from fieldgauge.llm.text import as_bytes, importable
from fieldgauge.llm.vectors import SCHEMA as PARTS
from fieldgauge.llm.vectors import blocks, tree_sum
from fieldgauge.session import materialise

#: distinct pairs whose counts are sent to every worker (16 bytes each); more are joined
MOST_PAIRS = 4_000_000
#: chunks whose alignment a Python worker remembers, of so many characters at most
REMEMBERED = 450_000
_LONG = 64
#: characters of text whose chunks are looked at together
_SECTION = 1_000_000
#: pairs that a task of the first pass holds before it hands their counts on
_HELD = 1_000_000
_LOW = 0xFFFFFFFF

#: a space after another character and before one that is not white space
_CUT = re.compile(r"(?<=[^ ]) (?=\S)")
_UNEVEN = re.compile(r" \s")
_BYTE_PIECE = re.compile(r"<0x([0-9A-F]{2})>")
_SPACE = "▁"
#: the end of the Latin letters
_KNOWN = "\u0250"

# fixed value: the words of byte-level vocabularies
BYTE_LEVEL_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_symbols() -> dict[str, int]:
    """The characters that byte-level vocabularies write for bytes.

    Printable Latin-1 bytes stand for themselves, the others for the characters from 256 on.
    """
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


@lru_cache(maxsize=2)
def ranks_of(byte_level: str) -> dict[bytes, int] | None:
    """The tokens' bytes and ids, if merging by the lowest id gives what the merge list gives.

    It does if the merges make their tokens in the order of the ids, from single bytes on, and
    every token is made from its own bytes: then wherever two neighbours spell a token, they are
    that token's own merge, as they would be if the token stood alone.
    """
    from tokenizers import Tokenizer, models

    model = json.loads(byte_level)["model"]
    vocab = model["vocab"]
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    made = [vocab.get(a + b, -1) for a, b in merges]
    symbols = byte_symbols()
    bases = sorted(vocab.get(c, -1) for c in symbols)
    if bases != list(range(256)) or made != list(range(256, 256 + len(merges))):
        return None
    alone = Tokenizer(models.BPE(vocab=vocab, merges=merges))
    tokens = [t for t, i in vocab.items() if i < 256 + len(merges)]
    if any(e.ids != [vocab[t]] for t, e in zip(tokens, alone.encode_batch(tokens))):
        return None
    return {bytes(symbols[c] for c in t): vocab[t] for t in tokens}


class Aligner:
    """Both tokenizers over one text or chunk."""

    def __init__(self, byte_level: str, pieces: bytes, ranks: dict[bytes, int] | None = None):
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_str(byte_level)
        tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.slow = lambda text: tokenizer.encode(text, add_special_tokens=False).ids
        self.quick = self.slow
        if ranks:
            self.quick = tiktoken.Encoding(
                "ranks", pat_str=BYTE_LEVEL_WORDS, mergeable_ranks=ranks, special_tokens={}
            ).encode_ordinary
        self.b = sentencepiece.SentencePieceProcessor(model_proto=pieces)
        symbols = byte_symbols()
        names = {i: t for t, i in json.loads(byte_level)["model"]["vocab"].items()}
        self.a_bytes = [bytes(symbols[c] for c in names.get(i, "")) for i in range(max(names) + 1)]
        self.b_bytes = []
        inside = False
        for i in range(self.b.vocab_size()):
            piece = self.b.id_to_piece(i)
            byte = _BYTE_PIECE.fullmatch(piece) if self.b.is_byte(i) else None
            self.b_bytes.append(bytes([int(byte[1], 16)]) if byte else piece.replace(_SPACE, " ").encode())
            inside |= _SPACE in piece.lstrip(_SPACE)
        #: no piece reaches over the start of a word, so chunks can be encoded one by one
        self.chunked = not inside
        self.a_size, self.b_size = _lengths(self.a_bytes), _lengths(self.b_bytes)

    def chunks(self, text: str) -> list[str]:
        """Parts of the text that both tokenizers encode as they do within it, less the space before each.

        Byte-level words start at a space before other text, whatever stands before it; pieces
        do not join a space to what precedes it unless that is a space too.
        """
        if not self.chunked:
            return [text]
        uneven = text[0] == " " or text[-1] == " " or "  " in text or _UNEVEN.search(text)
        return _CUT.split(text) if uneven else text.split(" ")

    def align(self, chunks: list[str]) -> Aligned:
        b = self.b.encode(chunks, num_threads=1) if chunks else []
        given = [f" {c}".encode() for c in chunks]
        sizes = _lengths(given)
        n_b = _lengths(b)
        flat_b = _flat(b)
        good = np.ones(len(chunks), bool)
        spelled = b"".join(map(self.b_bytes.__getitem__, flat_b.tolist())) == b"".join(given)
        if not (spelled and (_sums(self.b_size[flat_b], n_b) == sizes).all()):
            good = np.array([b"".join(map(self.b_bytes.__getitem__, x)) == g for x, g in zip(b, given)], bool)
            flat_b, n_b, sizes = _flat([x for x, ok in zip(b, good) if ok]), n_b[good], sizes[good]
        flat_a = self._encode_all([c for c, ok in zip(chunks, good) if ok])
        return Aligned(good, flat_a, flat_b, n_b, np.cumsum(sizes), self.a_size, self.b_size)

    def _encode_all(self, chunks: list[str]) -> np.ndarray:
        """A ids of each chunk after a space, one after the other."""
        # a chunk that itself begins or ends with a space does not part from its neighbours, and the
        # classes of later characters differ between Unicode versions
        quick = [_is_plain(c) for c in chunks]
        if all(quick):
            return np.array(self.quick(f" {' '.join(chunks)}") if chunks else [], np.int64)
        parts: list[list[int]] = []
        for alike, run in groupby(zip(quick, chunks), itemgetter(0)):
            texts = [c for _, c in run]
            parts += [self.quick(f" {' '.join(texts)}")] if alike else [self.slow(f" {c}") for c in texts]
        return _flat(parts)


def _is_plain(c: str) -> bool:
    if c.isascii() and c and c[0] > " ":
        return c[-1] != " "
    return bool(c) and not c[0].isspace() and c[-1] != " " and max(c) < _KNOWN


def _lengths(lists: list) -> np.ndarray:
    return np.fromiter(map(len, lists), np.int64, len(lists))


def _flat(lists: list[list[int]]) -> np.ndarray:
    return np.fromiter(chain.from_iterable(lists), np.int64, sum(map(len, lists)))


def _sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs of ``values`` with the given counts, 0 for an empty run."""
    upto = np.concatenate(([0], np.cumsum(values, axis=0))) if values.ndim == 1 else np.vstack(
        [np.zeros((1, values.shape[1]), np.int64), np.cumsum(values, axis=0)])
    ends = np.cumsum(counts)
    return upto[ends] - upto[ends - counts]


class Aligned:
    """Chunks aligned side by side, as if they were one text; they end together for both.

    ``good`` tells which chunks the tokens spell, all arrays are about those; ``links`` are the
    linked pairs (A id << 32 | B id) in order, repeats included.  ``link_ends`` and ``group_ends``
    count the links and the groups up to the end of each chunk, ``a_ends`` and ``b_ends`` the
    tokens up to the end of each group.
    """

    def __init__(self, good: np.ndarray, a: np.ndarray, b: np.ndarray, n_b: np.ndarray, chunk_ends: np.ndarray,
                 a_size: np.ndarray, b_size: np.ndarray):
        self.good, self.a, self.b, self.n_b = good, a, b, n_b
        ends_a, ends_b = np.cumsum(a_size[a]), np.cumsum(b_size[b])
        upto = np.searchsorted(ends_a, chunk_ends, "right")
        if len(chunk_ends) and (ends_a[upto - 1] != chunk_ends).any():
            raise RuntimeError("byte-level tokens do not end with their chunks")
        self.n_a = np.diff(upto, prepend=0)
        # between two ends of either kind lies exactly one token of each
        ends = np.union1d(ends_a, ends_b)
        self.links = (a[np.searchsorted(ends_a, ends)] << 32) | b[np.searchsorted(ends_b, ends)]
        common = np.intersect1d(ends_a, ends_b, assume_unique=True)
        self.link_ends = np.searchsorted(ends, chunk_ends, "right")
        self.group_ends = np.searchsorted(common, chunk_ends, "right")
        self.a_ends, self.b_ends = np.searchsorted(ends_a, common, "right"), np.searchsorted(ends_b, common, "right")

    def of_chunks(self, ends: np.ndarray, values: list) -> list[list]:
        """The values of each good chunk."""
        upto = ends.tolist()
        return [values[i:k] for i, k in zip([0, *upto], upto)]

    def group_texts(self, a_names: np.ndarray, b_names: np.ndarray) -> list[str]:
        """For each good chunk its groups, ``a1,a2|b1;`` with a semicolon after each.

        ``a_names`` and ``b_names`` hold the ids as texts, with a comma at 2 * id and with the mark
        that ends their side of a group at 2 * id + 1.
        """
        before_a = np.repeat(np.concatenate(([0], self.b_ends[:-1])), np.diff(self.a_ends, prepend=0))
        before_b = np.repeat(self.a_ends, np.diff(self.b_ends, prepend=0))
        last_a, last_b = np.zeros(len(self.a), np.int64), np.zeros(len(self.b), np.int64)
        last_a[self.a_ends - 1] = last_b[self.b_ends - 1] = 1
        out = np.empty(len(self.a) + len(self.b), object)
        out[np.arange(len(self.a)) + before_a] = a_names[2 * self.a + last_a]
        out[np.arange(len(self.b)) + before_b] = b_names[2 * self.b + last_b]
        return list(map("".join, self.of_chunks(np.cumsum(self.n_a + self.n_b), out.tolist())))


def id_names(n: int, end: str) -> np.ndarray:
    names = np.empty(2 * n, object)
    names[0::2] = [f"{i}," for i in range(n)]
    names[1::2] = [f"{i}{end}" for i in range(n)]
    return names


def _texts(column) -> Iterator[str | None]:
    """Texts as strings; None for null, empty and undecodable ones, which have no tokens."""
    for raw in column.to_pylist():
        try:
            yield raw.decode() if raw else None
        except UnicodeDecodeError:
            yield None


class _Chunks:
    """Numbers of the chunks that a Python worker remembers, and what ``keep`` stores of new ones.

    ``keep(first, aligned)`` is called with the number of the first new chunk and all new ones
    aligned; ``forget(numbers)`` with numbers that are not used again, None for all.
    """

    def __init__(self, aligner: Aligner, keep, forget):
        self.aligner, self.keep, self.forget = aligner, keep, forget
        self.numbers: dict[str, int] = {}
        self.next = 0
        self.long: list[str] = []

    def of(self, texts: list[str | None]) -> tuple[list[int], np.ndarray]:
        """The numbers of all chunks of the texts, and how many each text has; null and empty have none."""
        chunks = [self.aligner.chunks(t) if t else [] for t in texts]
        if self.long:
            self.forget([self.numbers.pop(c) for c in self.long])
            self.long = []
        if len(self.numbers) > REMEMBERED:
            self.numbers.clear()
            self.forget(None)
            self.next = 0
        new = list(set().union(*chunks) - self.numbers.keys())
        if new:
            self.keep(self.next, self.aligner.align(new))
            self.numbers.update(zip(new, range(self.next, self.next + len(new))))
            self.next += len(new)
            self.long = [c for c in new if len(c) > _LONG]
        return list(map(self.numbers.__getitem__, chain.from_iterable(chunks))), _lengths(chunks)


def _runs(numbers: list[int], counts: np.ndarray) -> Iterator[list[int]]:
    start = 0
    for n in counts.tolist():
        yield numbers[start : start + n]
        start += n


def _sections(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[str | None]]]:
    """Runs of rows with a bounded length of text, so that their chunks fit in memory."""
    for batch in batches:
        start = size = 0
        texts: list[str | None] = []
        for text in _texts(batch.column("text")):
            texts.append(text)
            size += len(text or "")
            if size > _SECTION:
                yield batch.slice(start, len(texts)), texts
                start, size, texts = start + len(texts), 0, []
        if texts:
            yield batch.slice(start, len(texts)), texts


class PairSets:
    """The distinct linked pairs of each text."""

    def __init__(self, aligner: Aligner):
        self.chunks = _Chunks(aligner, self._keep, self._forget)
        #: linked pairs by chunk number, None where the bytes differ
        self.pairs: list[list[int] | None] = []

    def _keep(self, first: int, found: Aligned) -> None:
        links = iter(found.of_chunks(found.link_ends, found.links.tolist()))
        self.pairs += [next(links) if ok else None for ok in found.good.tolist()]

    def _forget(self, numbers: list[int] | None) -> None:
        if numbers is None:
            self.pairs = []
        for i in numbers or ():
            self.pairs[i] = None

    def of(self, texts: list[str | None]) -> Iterator[set[int]]:
        for numbers in _runs(*self.chunks.of(texts)):
            held = list(map(self.pairs.__getitem__, set(numbers)))
            # if a chunk's bytes differ, so do the text's
            yield set() if None in held else set().union(*held)


@lru_cache(maxsize=1)
def _aligner(run: int, held) -> Aligner:
    """Kept by the Python worker, which serves many tasks, for the broadcast with number ``run``."""
    return Aligner(*held.value)


@lru_cache(maxsize=1)
def _pair_sets(run: int, held) -> PairSets:
    return PairSets(_aligner(run, held))


def _sent(spark: SparkSession, byte_level: str, pieces: bytes):
    return spark.sparkContext.broadcast((byte_level, pieces, ranks_of(byte_level)))


def pair_counts(docs: DataFrame, files) -> DataFrame:
    """pair (A id << 32 | B id) and n, the documents of a task that hold it linked; pairs repeat.

    ``files`` is the broadcast of what an ``Aligner`` is made from.
    """
    importable(docs.sparkSession)
    run_id = files._jbroadcast.id()

    def batch_of(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(counts.keys()), pa.int64()), pa.array(list(counts.values()), pa.int64())], ["pair", "n"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = _pair_sets(run_id, files)
        counts: Counter = Counter()
        for _, texts in _sections(batches):
            for found in pairs.of(texts):
                counts.update(found)
            if len(counts) > _HELD:
                yield batch_of(counts)
                counts.clear()
        yield batch_of(counts)

    return docs.select(as_bytes()).mapInArrow(run, "pair bigint, n bigint")


def dense_counts(pairs: DataFrame, numbers: PerfectHash) -> np.ndarray:
    """Documents of each pair, by the pair's number: one dense vector a task, summed in a tree."""
    spark = pairs.sparkSession
    tasks = max(1, spark.sparkContext.defaultParallelism)
    held = spark.sparkContext.broadcast(numbers)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        numbers, vector = held.value, None
        for batch in batches:
            if vector is None:
                vector = np.zeros(len(numbers.keys), np.int64)
            at = numbers.index(batch.column("pair").to_numpy())
            if (at < 0).any():
                raise RuntimeError("a pair of the first pass is not among the numbered ones")
            np.add.at(vector, at, batch.column("n").to_numpy())
        if vector is not None:
            yield from blocks(vector, TaskContext.get().partitionId())

    # few tasks, as each makes a whole vector
    parts = pairs.coalesce(tasks).mapInArrow(run, PARTS)
    return tree_sum(parts, tasks, len(numbers.keys), "int64")


class Counts:
    """Looks up what a chunk adds to its document."""

    def __init__(self, numbers: PerfectHash, counts: np.ndarray):
        self.numbers, self.counts = numbers, counts
        self.best = np.zeros(int(numbers.keys.max() >> 32) + 1 if len(numbers.keys) else 1, np.int64)
        np.maximum.at(self.best, numbers.keys >> 32, counts)

    def of(self, links: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each link whether its count is the highest of its A id, and the count."""
        at = self.numbers.index(links)
        if (at < 0).any():
            raise RuntimeError("a linked pair was not counted in the first pass")
        n = self.counts[at]
        return (n == self.best[links >> 32]).astype(np.int64), n


_SUMS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
_SCHEMA = ", ".join(f"{c} bigint" for c in ["doc_id", *_SUMS]) + ", `groups` string"


class Sums:
    """The result columns of each text, added up from its chunks."""

    def __init__(self, aligner: Aligner, counts: Counts | None):
        self.chunks = _Chunks(aligner, self._keep, self._forget)
        self.counts = counts
        self.names = id_names(len(aligner.a_bytes), "|"), id_names(len(aligner.b_bytes), ";")
        # by chunk number: the sums and whether the bytes differ, the text of the groups, the linked pairs
        self.sums = np.zeros((0, len(_SUMS) + 1), np.int64)
        self.groups: list[str] = []
        self.pairs: list[list[int]] = []

    def _keep(self, first: int, found: Aligned) -> None:
        n = len(found.good)
        rows = np.zeros((n, len(_SUMS) + 1), np.int64)
        rows[:, -1] = ~found.good
        n_links = np.diff(found.link_ends, prepend=0)
        columns = [found.n_a, found.n_b, np.diff(found.group_ends, prepend=0), n_links]
        if self.counts:
            columns += [_sums(x, n_links) for x in self.counts.of(found.links)]
        for i, column in enumerate(columns):
            rows[found.good, i] = column
        if first + n > len(self.sums):
            room = np.zeros((max(first + n, 2 * len(self.sums)), self.sums.shape[1]), np.int64)
            room[:first] = self.sums[:first]
            self.sums = room
        self.sums[first : first + n] = rows
        texts = iter(found.group_texts(*self.names))
        self.groups += [next(texts) if ok else "" for ok in found.good.tolist()]
        if not self.counts:
            links = iter(found.of_chunks(found.link_ends, found.links.tolist()))
            self.pairs += [next(links) if ok else [] for ok in found.good.tolist()]

    def _forget(self, numbers: list[int] | None) -> None:
        if numbers is None:
            self.groups, self.pairs = [], []
        for i in numbers or ():
            self.groups[i] = ""
            if not self.counts:
                self.pairs[i] = []

    def of(self, texts: list[str | None]) -> tuple[np.ndarray, list[str], list[list]]:
        """Sums, groups and linked pairs with their numbers; pairs only where there are no counts."""
        numbers, lengths = self.chunks.of(texts)
        sums = _sums(self.sums[numbers], lengths)
        whole = sums[:, -1] == 0
        sums[~whole] = 0
        groups, pairs = [], []
        for ok, run in zip(whole.tolist(), _runs(numbers, lengths)):
            # without the last semicolon
            groups.append("".join(map(self.groups.__getitem__, run))[:-1] if ok else "")
            if not self.counts:
                held = map(self.pairs.__getitem__, run) if ok else ()
                pairs.append(list(Counter(chain.from_iterable(held)).items()))
        return sums[:, :-1], groups, pairs


@lru_cache(maxsize=1)
def _counting(run: int, files, numbered) -> Sums:
    """Kept by the Python worker, as ``_aligner``."""
    return Sums(_aligner(run, files), Counts(*numbered.value) if numbered is not None else None)


def _aligned(docs: DataFrame, files, numbered=None) -> DataFrame:
    """The sums and groups of every row; without numbered counts, also its linked pairs."""
    run_id, with_pairs = files._jbroadcast.id(), numbered is None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = _counting(run_id, files, numbered)
        for batch, texts in _sections(batches):
            sums, groups, pairs = found.of(texts)
            columns = [batch.column("doc_id"), *(pa.array(c) for c in np.ascontiguousarray(sums.T)), pa.array(groups, pa.string())]
            names = ["doc_id", *_SUMS, "groups"]
            if with_pairs:
                kind = pa.list_(pa.struct([("pair", pa.int64()), ("times", pa.int64())]))
                columns.append(pa.array([[{"pair": p, "times": k} for p, k in x] for x in pairs], kind))
                names.append("pairs")
            yield pa.RecordBatch.from_arrays(columns, names)

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), as_bytes())
    more = ", pairs array<struct<pair:bigint,times:bigint>>" if with_pairs else ""
    return slim.mapInArrow(run, _SCHEMA + more)


def _joined(docs: DataFrame, pairs: DataFrame, files) -> DataFrame:
    """The same result with the counts as a table, for more pairs than are sent to the workers."""
    rows = materialise(
        _aligned(docs, files).withColumn("row", F.monotonically_increasing_id()), "aligned"
    )
    counts = materialise(pairs.groupBy("pair").agg(F.sum("n").alias("n")), "pairs")
    best = counts.groupBy(F.shiftright("pair", 32).alias("a")).agg(F.max("n").alias("most"))
    marked = materialise(
        counts.withColumn("a", F.shiftright("pair", 32)).join(best, "a").select(
            "pair", "n", (F.col("n") == F.col("most")).alias("top")),
        "pairs",
    )
    sums = (
        rows.select("row", F.explode("pairs").alias("x")).select("row", "x.pair", "x.times").join(marked, "pair")
        .groupBy("row").agg(F.sum(F.when(F.col("top"), F.col("times")).otherwise(F.lit(0))).alias("n_best"),
                            F.sum(F.col("times") * F.col("n")).alias("count_sum"))
    )
    return rows.drop("n_best", "count_sum", "pairs").join(sums, "row", "left").select(
        "doc_id", *_SUMS[:4], *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in _SUMS[4:]), "groups"
    )


def load(byte_level_path: str, pieces_path: str) -> tuple[str, bytes]:
    """The two vocabulary files, which are sent to the workers."""
    with open(byte_level_path, encoding="utf-8") as a, open(pieces_path, "rb") as b:
        return a.read(), b.read()


def align(docs: DataFrame, byte_level: str, pieces: bytes, most_pairs: int = MOST_PAIRS) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups of every row.

    A encodes a space and the text by the byte-level vocabulary, B the text by the piece
    vocabulary, which adds the space; strings of special tokens are ordinary text.  Byte offsets
    where tokens of both end cut them into groups, written ``a1,a2|b1;a3|b2,b3``.  Links are the
    pairs of an A and a B token whose byte ranges overlap; the count of an id pair is the number
    of documents that hold it linked, n_best the links whose count is the highest of their A id,
    count_sum the sum over links.  Null, empty and undecodable texts, and those whose tokens do
    not spell the text (a piece vocabulary reads U+2581 as a space), have no tokens: zeros and
    no groups.  Rows that repeat are documents of their own.  Other columns are not used.

    The pairs' counts are sent to every worker, 16 bytes each, if there are ``most_pairs`` at
    most, and are joined as a table beyond that.
    """
    spark: SparkSession = docs.sparkSession
    files = _sent(spark, byte_level, pieces)
    pairs = materialise(pair_counts(docs, files), "pairs")
    distinct = materialise(pairs.select("pair").distinct(), "pairs")
    n = distinct.count()
    if n > most_pairs:
        return _joined(docs, pairs, files)
    numbers = perfect_hash(distinct, "pair", n)
    counts = dense_counts(pairs, numbers)
    return _aligned(docs, files, spark.sparkContext.broadcast((numbers, counts)))
