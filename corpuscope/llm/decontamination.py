"""Benchmark decontamination with suffix arrays over shards of the training texts.

Each task cuts its documents into shards of a bounded number of bytes. Words that no benchmark
item holds become one sentinel, and so do runs of known words too short for any window; the rest become
numbers, and prefix doubling sorts the suffixes of a shard.
Every distinct window of the benchmark is found in it by binary search, and so is every test
suffix for its longest verbatim match. A document lies whole in one shard, so nothing is shuffled.

The benchmark is measured first and used in blocks of at most ``block_words`` words, each a
broadcast of bounded size; further blocks are further passes in the same Spark stage.

Defined cases: a NULL or empty text has no words and no hits. An item without words has no
windows. An item with a NULL id marks words but is not listed. Repeated rows and repeated item ids
are each taken as they come: one result per row, and one listed id for all items that share it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuscope.llm.common import as_bytes, grouped_batches, packed, unpacked

WINDOW = 10
SHARD_BYTES = 6 << 20
BLOCK_WORDS = 2_000_000

# Word characters are digits, letters and all from U+0080 on; A-Z count as a-z.
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(_FOLD).split() if text else []


@dataclass
class TestIndex:
    """One block of the benchmark: its vocabulary, items, and distinct windows."""

    vocabulary: dict[bytes, int]
    codes: np.ndarray  # all items' words, a 0 after each item
    suffixes: np.ndarray  # start of every word in codes
    item_of: np.ndarray  # by suffix: row in ids
    word_of: np.ndarray  # by suffix: word's place in its item
    left: np.ndarray  # by suffix: words to its item's end
    ids: list[int | None]
    starts: np.ndarray  # by distinct window: its start in codes
    depths: np.ndarray  # by distinct window: its words
    window_items: list[np.ndarray]  # by distinct window: ids of the items that hold it


def build_index(items: list[tuple[int | None, bytes | None]], window: int = WINDOW) -> TestIndex:
    vocabulary: dict[bytes, int] = {}
    codes: list[int] = []
    item_of, word_of, left, suffixes, ids = [], [], [], [], []
    seen: dict[bytes, int] = {}
    starts, depths, holders = [], [], []
    for item_id, text in items:
        words = [vocabulary.setdefault(w, len(vocabulary) + 1) for w in words_of(text)]
        if not words:
            continue
        base, n = len(codes), len(words)
        array = np.array(words, dtype=np.int32)
        depth = min(window, n)
        for p in range(n - depth + 1):
            k = seen.setdefault(array[p:p + depth].tobytes(), len(starts))
            if k == len(starts):
                starts.append(base + p)
                depths.append(depth)
                holders.append(set())
            if item_id is not None:
                holders[k].add(item_id)
        suffixes += range(base, base + n)
        item_of += [len(ids)] * n
        word_of += range(n)
        left += range(n, 0, -1)
        ids.append(item_id)
        codes += words
        codes.append(0)
    as_int = lambda x: np.array(x, dtype=np.int64)
    return TestIndex(
        vocabulary, np.array(codes, dtype=np.int32), as_int(suffixes), as_int(item_of), as_int(word_of),
        as_int(left), ids, as_int(starts), as_int(depths), [as_int(sorted(h)) for h in holders],
    )


def suffix_array(codes: np.ndarray, depth: int) -> np.ndarray:
    """Positions of all non-sentinel words, sorted by what follows up to the next sentinel.

    ``codes`` ends with a sentinel (0). Prefix doubling: ranks by the first 1, 2, 4, ... words until
    all differ or ``depth`` words are compared. Only positions still tied, and not ended by a
    sentinel, are ranked again.
    """
    n = len(codes)
    stops = np.flatnonzero(codes == 0)
    places = np.flatnonzero(codes)
    if not len(places):
        return places
    reach = stops[np.searchsorted(stops, places)] - places  # words to the sentinel
    rank = np.zeros(n + 1, dtype=np.int64)
    _, inverse, counts = np.unique(codes[places], return_inverse=True, return_counts=True)
    # A rank is one more than the number of suffixes before its group, so groups can be split in place.
    first = np.cumsum(counts) - counts
    rank[places] = first[inverse] + 1
    tied = np.flatnonzero((counts[inverse] > 1) & (reach > 1))
    k = 1
    while len(tied) and k < depth:
        # All members of a tied group are ranked, also those that end here: their second part is 0.
        group = rank[places]
        in_tie = np.zeros(len(places) + 2, dtype=bool)
        in_tie[group[tied]] = True
        chosen = np.flatnonzero(in_tie[group])
        at = places[chosen]
        second = np.where(reach[chosen] > k, rank[np.minimum(at + k, n)], 0)
        key = group[chosen] * (len(places) + 2) + second
        order = np.argsort(key, kind="stable")
        ranked = key[order]
        new = np.empty(len(order), dtype=bool)
        new[0] = True
        np.not_equal(ranked[1:], ranked[:-1], out=new[1:])
        group_first = group[chosen][order]
        place_in_all = np.arange(len(order))
        old_start = np.empty(len(order), dtype=bool)
        old_start[0] = True
        np.not_equal(group_first[1:], group_first[:-1], out=old_start[1:])
        base = np.maximum.accumulate(np.where(old_start, place_in_all, 0))
        start = np.maximum.accumulate(np.where(new, place_in_all, 0))
        rank[at[order]] = group_first + (start - base)
        k *= 2
        sizes = np.diff(np.append(np.flatnonzero(new), len(order)))
        size_of = np.repeat(sizes, sizes)
        tied = chosen[order][size_of > 1]
        tied = tied[reach[tied] > k]
    return places[np.argsort(rank[places], kind="stable")]


def _compare(codes, at, test, test_at, depth) -> tuple[np.ndarray, np.ndarray]:
    """Sign of training suffix against test suffix within ``depth`` words, and how many words agree."""
    sign = np.zeros(len(at), dtype=np.int8)
    same = np.zeros(len(at), dtype=np.int64)
    live = np.arange(len(at))
    d = 0
    while len(live):
        live = live[depth[live] > d]
        a, b = codes[at[live] + d], test[test_at[live] + d]
        differ = a != b
        out = live[differ]
        sign[out] = np.where(a[differ] < b[differ], -1, 1)
        live = live[~differ]
        d += 1
        same[live] = d
    return sign, same


def _bounds(codes, order, test, test_at, depth, right: bool) -> np.ndarray:
    """For each test suffix, how many training suffixes come before it (or, ``right``, also equal it)."""
    low = np.zeros(len(test_at), dtype=np.int64)
    high = np.full(len(test_at), len(order), dtype=np.int64)
    while True:
        live = np.flatnonzero(low < high)
        if not len(live):
            return low
        middle = (low[live] + high[live]) // 2
        sign, _ = _compare(codes, order[middle], test, test_at[live], depth[live])
        before = sign <= 0 if right else sign < 0
        low[live[before]] = middle[before] + 1
        high[live[~before]] = middle[~before]


class Shard:
    """Documents of one shard as numbers, and their suffix array."""

    def __init__(self, texts: list[bytes | None], index: TestIndex):
        self.index = index
        get, zero = index.vocabulary.get, repeat(0)
        codes: list[int] = []
        self.n_words = np.zeros(len(texts), dtype=np.int64)
        for k, text in enumerate(texts):
            words = words_of(text)
            self.n_words[k] = len(words)
            codes.extend(map(get, words, zero))
            codes.append(0)
        self.starts = np.cumsum(self.n_words + 1) - self.n_words - 1
        self.codes = np.array(codes, dtype=np.int32)
        # No window fits into a shorter run of known words: such words cannot be hit.
        stops = np.flatnonzero(self.codes == 0)
        runs = np.diff(stops, prepend=-1)
        self.codes[np.repeat(runs <= index.depths.min(initial=len(codes)), runs)] = 0
        longest = int(index.left.max(initial=1))
        self.order = suffix_array(self.codes, longest)

    def windows(self) -> tuple[np.ndarray, np.ndarray]:
        """All places where a window occurs: (word position in the shard, distinct window)."""
        x = self.index
        low = _bounds(self.codes, self.order, x.codes, x.starts, x.depths, right=False)
        high = _bounds(self.codes, self.order, x.codes, x.starts, x.depths, right=True)
        sizes = high - low
        within = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        return self.order[np.repeat(low, sizes) + within], np.repeat(np.arange(len(sizes)), sizes)

    def longest(self) -> tuple[np.ndarray, np.ndarray]:
        """For each test suffix its longest verbatim match in this shard: (words, word position)."""
        x = self.index
        best = np.zeros(len(x.suffixes), dtype=np.int64)
        place = np.zeros(len(x.suffixes), dtype=np.int64)
        if not len(self.order):
            return best, place
        low = _bounds(self.codes, self.order, x.codes, x.suffixes, x.left, right=False)
        # What sorts just before and just after a suffix shares the most words with it.
        for beside in (low - 1, low):
            ok = np.flatnonzero((beside >= 0) & (beside < len(self.order)))
            at = self.order[beside[ok]]
            _, same = _compare(self.codes, at, x.codes, x.suffixes[ok], x.left[ok])
            more = same > best[ok]
            best[ok[more]], place[ok[more]] = same[more], at[more]
        return best, place

    def document_of(self, position: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, position, "right") - 1


def _blocks(benchmark: DataFrame, item: str, text: str, window: int, block_words: int) -> Iterator[TestIndex]:
    """Indexes of bounded blocks of the benchmark; the number of words is measured first."""
    source = benchmark.select(F.col(item).cast("long").alias("item"), F.col(text).alias("text"))
    total = source.agg(F.sum(F.length("text"))).first()[0] or 0
    n = 1 + total // (2 * block_words)  # a word and its separator take two characters at least
    for k in range(n):
        block = source.filter(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == k)
        yield build_index([(r.item, r.text.encode() if r.text else None) for r in block.collect()], window)


def mark(
    documents: DataFrame, benchmark: DataFrame, *, text: str = "text", item: str = "item_id",
    item_text: str = "text", window: int = WINDOW, block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """One row per document: the whole ``row`` (a struct), ``n_words``, ``n_hit`` (words inside an
    occurrence of a benchmark window) and ``items`` (ids of the items that have such windows).

    Runs one small job to measure and read the benchmark.
    """
    spark = documents.sparkSession
    marked = packed(
        documents, n_words=F.lit(0).cast("long"), n_hit=F.lit(0).cast("long"), hit=F.lit(None).cast("binary"),
        items=F.array().cast("array<bigint>"),
    )
    schema = "n_words long, n_hit long, hit binary, items array<bigint>"
    for index in _blocks(benchmark, item, item_text, window, block_words):
        shared = spark.sparkContext.broadcast(index)
        marked = marked.mapInArrow(_marker(shared, text), _with(marked, schema))
    return marked.drop("hit")


def _with(marked: DataFrame, columns: str) -> str:
    return f"row {marked.schema['row'].dataType.simpleString()}, {columns}"


def _marker(shared, text: str):
    def run(batches):
        index: TestIndex = shared.value
        many = max(len(index.starts), 1)
        sizes = np.array([len(h) for h in index.window_items], dtype=np.int64)
        first = np.cumsum(sizes) - sizes
        holders = np.concatenate([np.zeros(0, dtype=np.int64), *index.window_items])
        for batch in grouped_batches(_with_text(batches, text), SHARD_BYTES, "text"):
            shard = Shard(as_bytes(batch.column("text")), index)
            position, window = shard.windows()
            edge = np.zeros(len(shard.codes) + 1, dtype=np.int64)
            np.add.at(edge, position, 1)
            np.add.at(edge, position + index.depths[window], -1)
            inside = np.cumsum(edge) > 0
            document = shard.document_of(position)
            owner, found = np.divmod(np.unique(document * many + window), many)
            listed = holders[_ranges(first[found], sizes[found])]
            cuts = np.searchsorted(np.repeat(owner, sizes[found]), np.arange(batch.num_rows + 1))
            n_hit, hit, items = (batch.column(c).to_pylist() for c in ("n_hit", "hit", "items"))
            for k in np.unique(document).tolist():
                begin, n = shard.starts[k], shard.n_words[k]
                bits = np.packbits(inside[begin:begin + n])
                if hit[k] is not None:  # what an earlier block found
                    bits |= np.frombuffer(hit[k], dtype=np.uint8)
                n_hit[k], hit[k] = int(np.unpackbits(bits).sum()), bits.tobytes()
                items[k] = sorted({*items[k], *listed[cuts[k]:cuts[k + 1]].tolist()})
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(shard.n_words), pa.array(n_hit, pa.int64()), pa.array(hit, pa.binary()),
                 pa.array(items, pa.list_(pa.int64()))],
                names=["row", "n_words", "n_hit", "hit", "items"],
            )

    return run


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of each range, one after another."""
    return np.repeat(starts - np.cumsum(sizes) + sizes, sizes) + np.arange(int(sizes.sum()))


def _with_text(batches, text: str) -> Iterator[pa.RecordBatch]:
    """Put the text inside ``row`` beside it."""
    for batch in batches:
        row = batch.column("row")
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, row.field(text)], names=[*batch.schema.names, "text"],
        )


def decontaminate(documents: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents, with all their columns, that hold no window of the benchmark."""
    return unpacked(mark(documents, benchmark, **options).filter("n_hit = 0"))


def longest_matches(
    documents: DataFrame, benchmark: DataFrame, *, key: str = "doc_id", text: str = "text", item: str = "item_id",
    item_text: str = "text", window: int = WINDOW, block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """For each benchmark item and word place the longest verbatim match (a full window at least) in
    the documents: item_id, item_word, words, and its location doc_id, doc_word.

    Each shard gives its best match for each test suffix; a grouped maximum merges the shards. Of
    equal matches the smallest document and place wins.
    """
    spark = documents.sparkSession
    source = packed(documents.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")))
    parts = []
    for index in _blocks(benchmark, item, item_text, window, block_words):
        shared = spark.sparkContext.broadcast(index)

        def run(batches, shared=shared):
            x: TestIndex = shared.value
            least = np.minimum(window, x.left + x.word_of)
            for batch in grouped_batches(_with_text(batches, "text"), SHARD_BYTES, "text"):
                shard = Shard(as_bytes(batch.column("text")), x)
                words, place = shard.longest()
                ok = np.flatnonzero(words >= least)
                document = shard.document_of(place[ok])
                keys = batch.column("row").field("doc_id")
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x.ids[k] for k in x.item_of[ok]], pa.int64()), pa.array(x.word_of[ok]), pa.array(words[ok]),
                     keys.take(pa.array(document)), pa.array(place[ok] - shard.starts[document])],
                    names=["item_id", "item_word", "words", "doc_id", "doc_word"],
                )

        parts.append(source.mapInArrow(run, "item_id long, item_word long, words long, doc_id long, doc_word long"))
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    best = F.min(F.struct((-F.col("words")).alias("less"), "doc_id", "doc_word")).alias("best")
    return found.groupBy("item_id", "item_word").agg(best).select(
        "item_id", "item_word", (-F.col("best.less")).alias("words"), "best.doc_id", "best.doc_word"
    )
