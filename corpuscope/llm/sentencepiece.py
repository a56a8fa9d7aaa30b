"""SentencePiece encoding and decoding by streaming Viterbi.

The segmentation of a text is the one of the highest total piece score. The streaming decoder keeps one best path
per boundary in a window of the longest piece, and backpointers since the last commit. Whenever all
boundaries that a later piece can still start from have a common ancestor, the ids up to it are final and leave
the memory, so a text of any length is decoded in a bounded window.

Where two neighbouring characters are inside no piece, all paths meet between them. For the usual vocabularies
that is so before every space mark and around line ends, so a text falls into short spans, each decoded on
its own. The distinct spans of a batch are decoded together, one array operation for each place in a span, and
remembered in a table of bounded size. Spans longer than ``LONG`` go through the streaming decoder.

The vocabulary is read from a model file (never trained here). Ties go to the longest last piece. A character that
no piece covers becomes its bytes' pieces, or the unknown piece if the vocabulary has no bytes.

Defined cases: NULL stays NULL; an empty text has no ids; decoding drops the leading space mark that
encoding puts before a text, so ``decode(encode(t)) == t`` for every text of a vocabulary with byte pieces
that does not itself hold the space mark (U+2581), which reads back as a space.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuscope.llm.common import grouped_batches, packed

SPACE = "▁"
LONG = 48
REMEMBERED = 100_000
CHUNK_BYTES = 2 << 20


class Vocabulary:
    """Pieces and scores of a model; what the decoders need is derived from them on first use."""

    def __init__(self, model: bytes):
        p = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = p.get_piece_size()
        self.pieces = p.id_to_piece(list(range(n)))
        special = [p.is_control(i) or p.is_unknown(i) or p.is_unused(i) for i in range(n)]
        self.byte_ids = {int(self.pieces[i][3:5], 16): i for i in range(n) if p.is_byte(i)}
        self.plain = {
            self.pieces[i]: (i, float(p.get_score(i)))
            for i in range(n) if not special[i] and not p.is_byte(i) and self.pieces[i]
        }
        self.controls = {i for i in range(n) if p.is_control(i)}
        self.unknown = p.unk_id()
        self.unknown_score = min((s for _, s in self.plain.values()), default=0.0) - 10.0
        self.longest = max(map(len, self.plain), default=1)

    @cached_property
    def spans(self) -> re.Pattern | None:
        """Cuts a marked text where no piece reaches across; None if such cuts aren't safe."""
        if any(SPACE in piece.lstrip(SPACE) or ("\n" in piece and len(piece) > 1) for piece in self.plain):
            return None
        return re.compile(f"{SPACE}+[^{SPACE}\n]*|\n|[^{SPACE}\n]+")

    @cached_property
    def trie(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Nodes as a hash table without collisions over (node, character): keys, next node; and id, score by node."""
        children: dict[tuple[int, int], int] = {}
        ids, scores = [-1], [0.0]
        for piece, (i, score) in self.plain.items():
            node = 0
            for ch in piece:
                node = children.setdefault((node, ord(ch)), len(ids))
                if node == len(ids):
                    ids.append(-1)
                    scores.append(0.0)
            ids[node], scores[node] = i, score
        keys = np.array([(node << 21) | ch for node, ch in children], dtype=np.uint64)
        order = np.argsort(keys)
        return keys[order], np.fromiter(children.values(), np.int64)[order], np.array(ids), np.array(scores), _slots(keys[order])

    def bytes_of(self, ch: str) -> list[int]:
        if len(self.byte_ids) < 256:
            return [self.unknown]
        return [self.byte_ids[b] for b in ch.encode("utf-8", "surrogatepass")]


_MIX = np.uint64(0x9E3779B97F4A7C15)
_BITS = 19


def _slot(keys: np.ndarray) -> np.ndarray:
    return ((keys * _MIX) >> np.uint64(64 - _BITS)).astype(np.int64)


def _slots(sorted_keys: np.ndarray) -> np.ndarray:
    """Open addressing: rank of the key in each slot, -1 where empty."""
    table = np.full(1 << _BITS, -1, dtype=np.int64)
    waiting = np.arange(len(sorted_keys))
    at = _slot(sorted_keys)
    while len(waiting):
        free = table[at[waiting]] < 0
        table[at[waiting[free]]] = waiting[free]  # of several for one slot, one stays
        waiting = waiting[table[at[waiting]] != waiting]
        at[waiting] = (at[waiting] + 1) % len(table)
    return table


class StreamingViterbi:
    """Decode characters as they come; :meth:`feed` returns the ids that have become final."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.text = ""  # characters since the last commit
        self.best: list[float] = [0.0]  # by boundary since the last commit
        self.back: list[tuple[int, int]] = [(0, 0)]  # the piece's start and its id (-1: bytes) by boundary
        self.most_held = 0

    def feed(self, characters: str) -> list[int]:
        out: list[int] = []
        plain, longest = self.v.plain, self.v.longest
        for ch in characters:
            self.text += ch
            end = len(self.text)
            score, back = -np.inf, (end - 1, -1)
            for start in range(max(0, end - longest), end):
                found = plain.get(self.text[start:end])
                if found and self.best[start] + found[1] > score:
                    score, back = self.best[start] + found[1], (start, found[0])
            if ch not in plain and self.best[end - 1] + self.v.unknown_score > score:
                score, back = self.best[end - 1] + self.v.unknown_score, (end - 1, -1)
            self.best.append(score)
            self.back.append(back)
            self.most_held = max(self.most_held, end)
            if end > 2 * longest:
                out += self._commit()
        return out

    def finish(self) -> list[int]:
        return self._ids(len(self.text))

    def _commit(self) -> list[int]:
        """Ids before the last boundary that all surviving paths go through."""
        # A later piece starts at one of the last ``longest`` boundaries.
        alive = set(range(len(self.text) - self.v.longest + 1, len(self.text) + 1))
        while len(alive) > 1:
            top = max(alive)
            alive.discard(top)
            alive.add(self.back[top][0])
        meet = alive.pop()
        if meet == 0:
            return []
        out = self._ids(meet)
        self.text = self.text[meet:]
        base = self.best[meet]
        self.best = [s - base for s in self.best[meet:]]
        self.back = [(start - meet, i) for start, i in self.back[meet:]]
        return out

    def _ids(self, end: int) -> list[int]:
        steps = []
        while end:
            start, i = self.back[end]
            steps.append([i] if i >= 0 else self.v.bytes_of(self.text[start:end]))
            end = start
        return [i for step in reversed(steps) for i in step]


def decode_spans(v: Vocabulary, spans: list[str]) -> list[bytes]:
    """Viterbi of many short spans at once; ids of each as little-endian int32 bytes."""
    if not spans:
        return []
    keys, nexts, ids, scores, table = v.trie
    lengths = np.fromiter(map(len, spans), dtype=np.int64, count=len(spans))
    order = np.argsort(-lengths, kind="stable")  # spans that reach a place are then a prefix
    lengths = lengths[order]
    width = int(lengths[0])
    codes = np.zeros((len(spans), width + 1), dtype=np.uint64)
    flat = np.frombuffer("".join([spans[k] for k in order]).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    filled = np.arange(width + 1) < lengths[:, None]
    codes[filled] = flat
    best = np.full((len(spans), width + 1), -np.inf)
    best[:, 0] = 0.0
    back_start = np.zeros((len(spans), width + 1), dtype=np.int16)
    back_id = np.full((len(spans), width + 1), -1, dtype=np.int32)
    for start in range(width):
        rows = np.arange(int(np.searchsorted(-lengths, -start, "left")))  # spans longer than start
        node = np.zeros(len(rows), dtype=np.int64)
        for reach in range(1, v.longest + 1):
            end = start + reach
            if end > width:
                break
            ch = codes[rows, end - 1]
            key = (node.astype(np.uint64) << np.uint64(21)) | ch
            node = _next(keys, nexts, table, key)
            live = (node >= 0) & (end <= lengths[rows])
            piece = np.where(live, ids[node], -1)
            if reach == 1:  # a character that is no piece itself
                bare = rows[(piece < 0)]
                score = best[bare, start] + v.unknown_score
                better = score > best[bare, end]
                bare = bare[better]
                best[bare, end], back_start[bare, end], back_id[bare, end] = score[better], start, -1
            hit = piece >= 0
            at = rows[hit]
            score = best[at, start] + scores[node[hit]]
            better = score > best[at, end]
            at = at[better]
            best[at, end], back_start[at, end], back_id[at, end] = score[better], start, piece[hit][better]
            rows, node = rows[live], node[live]
            if not len(rows):
                break
    # Walk all spans back together.
    at = lengths.copy()
    starts, found = [], []
    while True:
        live = np.flatnonzero(at)
        if not len(live):
            break
        step_id = np.full(len(spans), -2, dtype=np.int32)
        step_start = np.zeros(len(spans), dtype=np.int64)
        step_id[live] = back_id[live, at[live]]
        step_start[live] = back_start[live, at[live]]
        found.append(step_id)
        starts.append(step_start)
        at[live] = step_start[live]
    found, starts = np.array(found[::-1], dtype=np.int32).T, np.array(starts[::-1]).T
    out: list[bytes] = [b""] * len(spans)
    has_bytes = (found == -1).any(axis=1)
    kept = found >= 0
    counts = kept.sum(axis=1)
    joined = found[kept].astype("<i4").tobytes()
    stops = (np.cumsum(counts) * 4).tolist()
    begin = 0
    for row, (k, stop) in enumerate(zip(order.tolist(), stops)):
        out[k] = joined[begin:stop]
        begin = stop
        if has_bytes[row]:
            mixed: list[int] = []
            for i, start in zip(found[row].tolist(), starts[row].tolist()):
                mixed += [] if i == -2 else [i] if i >= 0 else v.bytes_of(spans[k][start])
            out[k] = np.array(mixed, dtype="<i4").tobytes()
    return out


def _next(keys, nexts, table, wanted) -> np.ndarray:
    """Next trie node for each (node, character) key, -1 if there is none."""
    out = np.full(len(wanted), -1, dtype=np.int64)
    at = _slot(wanted)
    live = np.arange(len(wanted))
    while len(live):
        rank = table[at[live]]
        live, rank = live[rank >= 0], rank[rank >= 0]
        same = keys[rank] == wanted[live]
        out[live[same]] = nexts[rank[same]]
        live = live[~same]
        at[live] = (at[live] + 1) % len(table)
    return out


class Encoder:
    """Encode texts of one task, remembering the ids of spans in a table of bounded size."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.known: dict[str, bytes] = {}

    def stream(self, text: str) -> bytes:
        viterbi = StreamingViterbi(self.v)
        return np.array(viterbi.feed(text) + viterbi.finish(), dtype="<i4").tobytes()

    def encode(self, texts: list[str | None]) -> list[bytes | None]:
        """Ids of each text as little-endian int32 bytes."""
        marked = [SPACE + t.replace(" ", SPACE) if t else t for t in texts]
        if self.v.spans is None:
            return [self.stream(t) if t else (None if t is None else b"") for t in marked]
        split = [self.v.spans.findall(t) if t else [] for t in marked]
        known = self.known
        fresh = list(set(itertools.chain.from_iterable(split)).difference(known))
        if len(known) + len(fresh) > REMEMBERED:
            known = self.known = {}
            fresh = list(set(itertools.chain.from_iterable(split)))
        short = [s for s in fresh if len(s) <= LONG]
        short.sort(key=len)
        for k in range(0, len(short), 20_000):  # of like lengths, so little room is left empty
            part = short[k:k + 20_000]
            known.update(zip(part, decode_spans(self.v, part)))
        known.update((s, self.stream(s)) for s in fresh if len(s) > LONG)
        get = known.__getitem__
        return [None if t is None else b"".join(map(get, s)) for t, s in zip(texts, split)]

    def decode(self, ids: np.ndarray) -> str:
        return decode(self.v, ids)


def decode(v: Vocabulary, ids) -> str:
    """Text of a list of ids; bytes that are no UTF-8 become U+FFFD, control pieces nothing."""
    table = _decode_table(v)
    raw = b"".join(map(table.__getitem__, ids if isinstance(ids, list) else ids.tolist()))
    text = raw.decode("utf-8", "replace")
    return text[1:] if text.startswith(" ") else text


def _decode_table(v: Vocabulary) -> list[bytes]:
    table = v.__dict__.get("decoded")
    if table is None:
        back = {i: bytes([b]) for b, i in v.byte_ids.items()}
        table = v.__dict__["decoded"] = [
            b"" if i in v.controls else back[i] if i in back else p.replace(SPACE, " ").encode() for i, p in enumerate(v.pieces)
        ]
    return table


def encode_table(documents: DataFrame, model: bytes, *, text: str = "text", check: bool = False) -> DataFrame:
    """``row`` (the whole row) and ``ids`` (array<int>); with ``check`` also ``decoded``, the text read back.

    ``model`` is the content of a model file, some hundred kilobytes, and is sent to the tasks as it is.
    """
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        v = Vocabulary(shared.value)
        encoder = Encoder(v)
        for rows in grouped_batches(_with_text(batches, text), CHUNK_BYTES, "text"):
            texts = rows.column("text").to_pylist()
            coded = encoder.encode(texts)
            columns, names = [rows.column("row"), _lists(coded)], ["row", "ids"]
            if check:
                columns.append(pa.array([
                    None if c is None else decode(v, np.frombuffer(c, dtype="<i4")) for c in coded
                ], pa.string()))
                names.append("decoded")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    source = packed(documents)
    kind = source.schema["row"].dataType.simpleString()
    return source.mapInArrow(run, f"row {kind}, ids array<int>" + (", decoded string" if check else ""))


def decode_table(coded: DataFrame, model: bytes, *, ids: str = "ids") -> DataFrame:
    """``row`` (the whole row) and ``decoded`` (string)."""
    shared = coded.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        v = Vocabulary(shared.value)
        for rows in batches:
            lists = rows.column("row").field(ids).to_pylist()
            texts = [None if x is None else decode(v, x) for x in lists]
            yield pa.RecordBatch.from_arrays([rows.column("row"), pa.array(texts, pa.string())], names=["row", "decoded"])

    source = packed(coded)
    return source.mapInArrow(run, f"row {source.schema['row'].dataType.simpleString()}, decoded string")


def _with_text(batches, text: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        row = batch.column("row")
        yield pa.RecordBatch.from_arrays([*batch.columns, row.field(text)], names=[*batch.schema.names, "text"])


def _lists(coded: list[bytes | None]) -> pa.Array:
    sizes = np.fromiter((len(c) // 4 if c else 0 for c in coded), dtype=np.int64, count=len(coded))
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    values = pa.array(np.frombuffer(b"".join(c for c in coded if c), dtype="<i4"), pa.int32())
    missing = np.array([c is None for c in coded], dtype=bool)
    if missing.any():
        return pa.ListArray.from_arrays(pa.array(offsets), values, mask=pa.array(missing))
    return pa.ListArray.from_arrays(pa.array(offsets), values)
