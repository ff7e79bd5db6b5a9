"""Byte-level BPE: texts to token ids and back, by DuckDB queries inside each partition.

A text is split by a pattern; every distinct piece is encoded once per batch. A piece starts as
one row per byte and position. A recursive query joins neighbouring rows with the merge table,
finds each piece's pair of lowest rank, and contracts its leftmost occurrence, until no pair of
the piece is in the table. Decoding joins ids with the vocabulary and puts the bytes together
in order of position.

Contracting only the leftmost occurrence takes one step per pair. In long pieces all occurrences
are contracted in one step, left to right, where that gives the same tokens: where no pair that
the new token makes with a neighbour has a lower rank. So long runs of one character take few
steps.

Defined results:

* A null or empty text has no tokens and decodes to an empty text.
* Special tokens are not known: their names are ordinary text.
* A piece that is itself in the vocabulary is that token.
* Repeated rows are encoded alike and all kept. Every column of the input stays, except one
  that is named like an output column.
* Texts are handled whole, at any length. Ids that are not in the vocabulary are an error.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Callable, Generator, Iterator, Sequence
from dataclasses import dataclass
from itertools import pairwise

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from sendgate.llm.common import fresh, return_memory

# Texts of about this many bytes are split, or decoded, at a time.
CHUNK_BYTES = 2 << 20
# A query encodes pieces of about this many bytes at a time.
PIECE_BYTES = 1 << 20
# Encoded pieces that a task remembers, some 200 bytes each; it starts afresh beyond.
REMEMBERED = 300_000
# Pieces up to this many bytes take one contraction per step; longer ones are cut into windows
# of as many bytes.
SHORT_BYTES = 64
OVERLAP = SHORT_BYTES // 2
# Windows of a piece that are asked for at a time.
WINDOWS = 4_096
# Longer pieces and windows, in bytes, are not remembered.
REMEMBERED_BYTES = 4_096
# Ids that a query decodes at a time.
DECODED_IDS = 1 << 18
# Nothing is written to a disk: a chunk's rows fit in memory.
DUCKDB = {"threads": 1, "memory_limit": "400MB", "temp_directory": ""}


@dataclass(frozen=True)
class Sizes:
    """What a task works on at a time and remembers; less takes less memory and more time."""

    chunk_bytes: int = CHUNK_BYTES
    piece_bytes: int = PIECE_BYTES
    remembered: int = REMEMBERED


# For workers that share their executor's memory with much else: about a quarter.
FRUGAL = Sizes(CHUNK_BYTES // 4, PIECE_BYTES // 4, REMEMBERED // 4)


@dataclass(frozen=True)
class Vocabulary:
    """Ranks of a byte-level BPE, as the text of a rank file, and the pattern that splits texts.

    A rank file has a fixed size, some hundred kilobytes, and travels with the code. It has to
    hold every single byte, and ranks below 65,536.
    """

    ranks: bytes
    pattern: str

    @classmethod
    def read(cls, path: str, pattern: str) -> Vocabulary:
        with open(path, "rb") as file:
            return cls(file.read(), pattern)


def parse_ranks(text: bytes) -> dict[bytes, int]:
    return {
        base64.b64decode(token): int(rank)
        for token, rank in (line.split() for line in text.splitlines() if line.strip())
    }


def merge_rows(ranks: dict[bytes, int]) -> Iterator[tuple[int, int, int]]:
    """Every pair of tokens whose bytes make a token: left, right and merged."""
    for token, rank in ranks.items():
        for i in range(1, len(token)):
            left, right = ranks.get(token[:i]), ranks.get(token[i:])
            if left is not None and right is not None:
                yield left, right, rank


# One pair of every piece per step: its lowest rank, leftmost. A row per position is joined with
# the merges; ``merged * 2**20 + position`` orders the found pairs.
_ENCODE_SHORT = """
with recursive step as (
    select word, ids, true as busy from pieces
    union all (
        with pairs as (
            select word, unnest(range(1, len(ids))) as pos,
                   unnest(ids[:-2]) * 65536 + unnest(ids[2:]) as pair
            from step where busy
        ),
        best as (
            select word, min(merged * 1048576 + pos) as best
            from pairs join merges using (pair) group by word
        )
        select s.word, case when best is null then ids
            else ids[:best % 1048576 - 1] || [best // 1048576] || ids[best % 1048576 + 2:]
            end as ids, best is not null as busy
        from (select word, ids from step where busy) as s left join best using (word)
    )
)
select word, ids from step where not busy
"""

# Long pieces: all occurrences of the lowest rank in one step, every second one where they
# overlap, unless a new neighbour pair would have a lower rank still.
_ENCODE_LONG = """
with recursive step as (
    select word, unnest(range(len(ids))) as pos, unnest(ids) as id, true as busy from pieces
    union all (
        with paired as (
            select s.*, m.merged, min(m.merged) over (partition by word) as best
            from (select word, pos, id, lag(id) over w as before, lead(id) over w as following,
                         lead(id, 2) over w as after, row_number() over w as nth
                  from step where busy window w as (partition by word order by pos)) as s
            left join merges as m on m.pair = s.id * 65536 + s.following
        ),
        ordered as (
            select *, merged is not null and merged = best as fits,
                   row_number() over (partition by word, merged is not null and merged = best
                                      order by nth) as nth_fit
            from paired
        ),
        dealt as (
            select *, fits and row_number() over (partition by word, fits, nth - nth_fit
                                                  order by nth) % 2 = 1 as second
            from ordered
        ),
        judged as (
            select dealt.*, coalesce(bool_or(second and (
                       x.pair is not null or y.pair is not null or z.pair is not null))
                       over (partition by word), false) as risky
            from dealt
            left join risks as x on x.pair = before * 65536 + best
            left join risks as y on y.pair = best * 65536 + after
            left join risks as z on z.pair = best * 65536 + best
        ),
        chosen as (
            select *, case when risky then fits and nth_fit = 1 else second end as starts
            from judged
        ),
        gone as (
            select *, coalesce(lag(starts) over (partition by word order by nth), false) as eaten
            from chosen
        )
        select word, pos, case when starts then best else id end as id, best is not null as busy
        from gone where not eaten
    )
)
select word, list(id order by pos) as ids from step where not busy group by word
"""

_DECODE = """
select text_no, unhex(array_to_string(list(token order by pos), '')) as bytes
from encoded join vocabulary using (id)
group by text_no
"""


class Codec:
    """The tables of one vocabulary in a DuckDB database of this process."""

    def __init__(self, vocabulary: Vocabulary, sizes: Sizes | None = None) -> None:
        self.sizes = sizes or Sizes()
        self.ranks = parse_ranks(vocabulary.ranks)
        self.split = regex.compile(vocabulary.pattern).findall
        self.database = duckdb.connect(config=DUCKDB)
        self.words: dict[str, bytes] = {}
        self.windows: dict[bytes, bytes] = {}
        # Straight into numbers, as lists of them would be most of what a worker takes.
        flat = np.fromiter((x for row in merge_rows(self.ranks) for x in row), np.int64)
        left, right, merged = flat.reshape(-1, 3).T
        tables = {
            "merges": pa.table(
                {
                    "pair": left * 65536 + right,
                    "merged": merged.copy(),
                    # Does the merged token come before one of its own parts?
                    "early": merged < np.maximum(left, right),
                }
            ),
            "vocabulary": pa.table(
                {
                    "id": list(self.ranks.values()),
                    "token": [token.hex().upper() for token in self.ranks],
                }
            ),
        }
        for name, table in tables.items():
            self.database.register("given", table)
            self.database.execute(f"create table {name} as select * from given")
            self.database.unregister("given")
        self.database.execute("create table risks as select pair from merges where early")
        self.byte_ids = np.array([self.ranks[bytes([byte])] for byte in range(256)])
        self.known_ids = np.array(sorted(self.ranks.values()))
        self.lengths = np.zeros(self.known_ids[-1] + 1, np.int64)
        for token, rank in self.ranks.items():
            self.lengths[rank] = len(token)
        return_memory()

    def close(self) -> None:
        self.words.clear()
        self.windows.clear()
        self.database.close()

    def encode_words(self, words: list[str]) -> None:
        """Remember the ids of pieces, as little-endian unsigned 32-bit integers."""
        short: list[bytes] = []
        names: list[str] = []
        long: dict[str, bytes] = {}
        for word in words:
            piece = word.encode()
            whole = self.ranks.get(piece)
            if whole is not None:
                self.words[word] = whole.to_bytes(4, "little")
            elif len(piece) <= SHORT_BYTES:
                names.append(word)
                short.append(piece)
            else:
                long[word] = piece
        self.words.update(zip(names, self._contracted(short), strict=True))
        self._encode_long(long)

    def _encode_long(self, pieces: dict[str, bytes]) -> None:
        """Put long pieces together, all of them side by side so that they share queries."""
        asking = {}
        for word, piece in pieces.items():
            joining = _joined(piece, self.lengths)
            asking[word] = (joining, next(joining))
        while asking:
            wanted = {window for _, windows in asking.values() for window in windows}
            fresh_ones = sorted(wanted.difference(self.windows))
            found = dict(zip(fresh_ones, self._contracted(fresh_ones), strict=True))
            found |= {window: self.windows[window] for window in wanted.difference(found)}
            if len(self.windows) + len(found) > self.sizes.remembered // 8:
                self.windows.clear()
            self.windows.update(
                (window, ids) for window, ids in found.items() if len(window) <= REMEMBERED_BYTES
            )
            for word, (joining, windows) in list(asking.items()):
                try:
                    asking[word] = (joining, joining.send([found[w] for w in windows]))
                except StopIteration as finished:
                    self.words[word] = finished.value
                    del asking[word]

    def _contracted(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of pieces, each by itself, as little-endian unsigned 32-bit integers."""
        result: list[bytes] = [b""] * len(pieces)
        numbered = list(enumerate(pieces))
        for query, rest in (
            (_ENCODE_SHORT, [one for one in numbered if len(one[1]) <= SHORT_BYTES]),
            (_ENCODE_LONG, [one for one in numbered if len(one[1]) > SHORT_BYTES]),
        ):
            for part in _in_chunks(rest, lambda item: len(item[1]), self.sizes.piece_bytes):
                for (number, _), ids in zip(part, self._contract(query, part), strict=True):
                    result[number] = ids
        return result

    def _contract(self, query: str, part: list[tuple[int, bytes]]) -> list[bytes]:
        raw = [piece for _, piece in part]
        ids = self.byte_ids[np.frombuffer(b"".join(raw), np.uint8)]
        offsets = np.cumsum([0, *map(len, raw)], dtype=np.int32)
        pieces = pa.table(
            {
                "word": np.arange(len(part)),
                "ids": pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids)),
            }
        )
        self.database.register("pieces", pieces)
        found = self.database.sql(query).to_arrow_table()
        self.database.unregister("pieces")
        ids = found["ids"].combine_chunks()
        ends = ids.offsets.to_pylist()
        flat = ids.values.cast(pa.uint32()).to_numpy(zero_copy_only=False).tobytes()
        result: list[bytes] = [b""] * len(part)
        for row, number in enumerate(found["word"].to_pylist()):
            result[number] = flat[4 * ends[row] : 4 * ends[row + 1]]
        return result

    def encode(self, texts: list[str | None]) -> Iterator[list[bytes]]:
        """Ids of each text as little-endian unsigned 32-bit integers, some texts at a time."""
        for part in _in_chunks(texts, lambda text: len(text or ""), self.sizes.chunk_bytes):
            split = [self.split(text) if text else [] for text in part]
            if len(self.words) > self.sizes.remembered:
                self.words.clear()
            new: set[str] = set()
            for words in split:
                new.update(words)
            new.difference_update(self.words)
            self.encode_words(sorted(new))
            ids_of = self.words.__getitem__
            encoded = [b"".join(map(ids_of, words)) for words in split]
            for word in new:
                if len(word) > REMEMBERED_BYTES:
                    del self.words[word]
            yield encoded

    def decode(self, encoded: Sequence[Sequence[int] | None] | pa.ListArray) -> list[bytes]:
        """The bytes that the ids of each text stand for."""
        if not isinstance(encoded, pa.ListArray):
            encoded = pa.array(encoded, pa.list_(pa.int64()))
        flat = encoded.flatten().to_numpy()
        if not len(flat):
            return [b""] * len(encoded)
        lengths = pc.fill_null(pc.list_value_length(encoded), 0).to_numpy()
        if not np.isin(flat, self.known_ids).all():
            raise ValueError("an id is not in the vocabulary")
        text_no = np.repeat(np.arange(len(encoded)), lengths)
        parts: dict[int, list[bytes]] = {}
        for first in range(0, len(flat), DECODED_IDS):
            some = slice(first, first + DECODED_IDS)
            rows = {"text_no": text_no[some], "pos": np.arange(len(flat[some])), "id": flat[some]}
            self.database.register("encoded", pa.table(rows))
            found = self.database.sql(_DECODE).to_arrow_table()
            self.database.unregister("encoded")
            for text, part in zip(*(found[c].to_pylist() for c in ("text_no", "bytes")), strict=True):
                parts.setdefault(text, []).append(part)
        return [b"".join(parts.get(i, ())) for i in range(len(encoded))]


@dataclass
class _Window:
    """Ids of a stretch of a piece, and where its tokens start and end."""

    ids: np.ndarray
    bounds: np.ndarray

    @classmethod
    def of(cls, start: int, ids: bytes, lengths: np.ndarray) -> _Window:
        numbers = np.frombuffer(ids, "<u4")
        return cls(numbers, np.concatenate(([start], start + np.cumsum(lengths[numbers]))))

    def shared(self, other: _Window) -> tuple[int, int] | None:
        """Places in both of the first token that both have."""
        _, mine, others = np.intersect1d(
            self.bounds, other.bounds, assume_unique=True, return_indices=True
        )
        both = np.flatnonzero((np.diff(mine) == 1) & (np.diff(others) == 1))
        return (int(mine[both[0]]), int(others[both[0]])) if len(both) else None

    def since(self, place: int) -> _Window:
        return _Window(self.ids[place:], self.bounds[place:])


def _joined(piece: bytes, lengths: np.ndarray) -> Generator[list[bytes], list[bytes], bytes]:
    """Ids of a long piece: asks for the ids of windows and puts them together."""
    stride = SHORT_BYTES - OVERLAP
    ready: dict[int, bytes] = {}
    held: list[bytes] = []
    (first,) = yield [piece[:SHORT_BYTES]]
    current = _Window.of(0, first, lengths)
    while (end := int(current.bounds[-1])) < len(piece):
        number = (end - OVERLAP) // stride
        if number not in ready:
            starts = range(number * stride, len(piece), stride)[:WINDOWS]
            found = yield [piece[start : start + SHORT_BYTES] for start in starts]
            ready = dict(enumerate(found, number))
        following = _Window.of(number * stride, ready[number], lengths)
        places = current.shared(following)
        reach, back = SHORT_BYTES, OVERLAP // 2
        while places is None:
            # From a token of the current window, further back and further on each time.
            token = max(0, int(np.searchsorted(current.bounds[:-1], end - back)) - 1)
            start = int(current.bounds[token])
            # Windows end where one of the regular ones has its overlap.
            until = max(end + stride, start + reach - (start + reach - OVERLAP) % stride)
            if until >= len(piece) and token == 0 and reach > SHORT_BYTES:
                return (yield [piece])[0]
            (found_ids,) = yield [piece[start:until]]
            following = _Window.of(start, found_ids, lengths)
            places = current.shared(following)
            reach, back = 4 * reach, 4 * back
        mine, others = places
        held.append(current.ids[:mine].tobytes())
        current = following.since(others)
    held.append(current.ids.tobytes())
    return b"".join(held)


def _in_chunks(items: list, size: Callable[[object], int], most: int) -> Iterator[list]:
    part: list = []
    held = 0
    for item in items:
        part.append(item)
        held += size(item)
        if held >= most:
            yield part
            part, held = [], 0
    if part:
        yield part


def _in_rows(batch: pa.RecordBatch, size: pa.Array) -> Iterator[pa.RecordBatch]:
    """Slices of a batch, of some ``CHUNK_BYTES`` each."""
    first = held = 0
    for row, n in enumerate(size.to_pylist()):
        held += n or 0
        if held >= CHUNK_BYTES:
            yield batch.slice(first, row + 1 - first)
            first, held = row + 1, 0
    if first < batch.num_rows:
        yield batch.slice(first)


def _with(df: DataFrame, *fields: StructField) -> StructType:
    names = {field.name.lower() for field in fields}
    return StructType([f for f in df.schema if f.name.lower() not in names] + list(fields))


def _appended(batch: pa.RecordBatch, columns: dict[str, pa.Array]) -> pa.RecordBatch:
    names = {name.lower() for name in columns}
    kept = [name for name in batch.schema.names if name.lower() not in names]
    return pa.RecordBatch.from_arrays(
        [*(batch.column(name) for name in kept), *columns.values()], [*kept, *columns]
    )


def _ids_array(encoded: list[bytes]) -> pa.Array:
    offsets = [0]
    for ids in encoded:
        offsets.append(offsets[-1] + len(ids) // 4)
    flat = pa.Array.from_buffers(
        pa.int32(), offsets[-1], [None, pa.py_buffer(b"".join(encoded))]
    )
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), flat)


Batches = Iterator[pa.RecordBatch]


def _opened(
    vocabulary: Vocabulary, work: Callable[[Codec], Batches], sizes: Sizes | None = None
) -> Batches:
    """Work with a codec of the task's own: a worker that lives on holds nothing of it."""
    codec = Codec(vocabulary, sizes)
    try:
        yield from work(codec)
    finally:
        codec.close()
        return_memory()


def _encode(batches: Batches, codec: Codec, text: str, ids: str) -> Batches:
    for batch in batches:
        for rows in _in_rows(batch, pc.binary_length(batch.column(text))):
            texts = rows.column(text).to_pylist()
            encoded = [x for part in codec.encode(texts) for x in part]
            yield _appended(rows, {ids: _ids_array(encoded)})


def _decode(batches: Batches, codec: Codec, ids: str, decoded: str) -> Batches:
    for batch in batches:
        # A token stands for some three bytes.
        lengths = pc.multiply(pc.list_value_length(batch.column(ids)), 3)
        for rows in _in_rows(batch, lengths):
            found = codec.decode(rows.column(ids))
            yield _appended(rows, {decoded: pa.array(found, pa.binary())})


def _digest(batches: Batches, dropped: Sequence[str], ids: str, decoded: str) -> Batches:
    for batch in batches:
        arrays = batch.column(ids)
        flat = arrays.values.to_numpy().astype("<u4", copy=False)
        ends = arrays.offsets.to_pylist()
        spans = list(pairwise(ends))
        columns = {
            "n_tokens": pa.array([b - a for a, b in spans], pa.int64()),
            "ids_sha256": pa.array(
                [hashlib.sha256(flat[a:b].tobytes()).hexdigest() for a, b in spans], pa.string()
            ),
            "decoded_sha256": pa.array(
                [hashlib.sha256(x.as_py()).hexdigest() for x in batch.column(decoded)],
                pa.string(),
            ),
        }
        names = {name.lower() for name in (*dropped, *columns)}
        kept = [name for name in batch.schema.names if name.lower() not in names]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(name) for name in kept), *columns.values()], [*kept, *columns]
        )


def encode_texts(
    df: DataFrame, vocabulary: Vocabulary, text: str = "text", ids: str = "ids"
) -> DataFrame:
    """``df`` with the token ids of its texts, an array of integers."""
    schema = _with(df, StructField(ids, ArrayType(IntegerType())))
    return df.mapInArrow(
        lambda batches: _opened(vocabulary, lambda codec: _encode(batches, codec, text, ids)),
        schema,
    )


def decode_ids(
    df: DataFrame, vocabulary: Vocabulary, ids: str = "ids", decoded: str = "decoded"
) -> DataFrame:
    """``df`` with the bytes that its token ids stand for."""
    schema = _with(df, StructField(decoded, BinaryType()))
    return df.mapInArrow(
        lambda batches: _opened(vocabulary, lambda codec: _decode(batches, codec, ids, decoded)),
        schema,
    )


def encode_and_decode(
    df: DataFrame,
    vocabulary: Vocabulary,
    text: str = "text",
    keep_ids: bool = False,
    sizes: Sizes | None = None,
) -> DataFrame:
    """Encode every text, decode the ids again, and put both results' digests in its place.

    The columns n_tokens, ids_sha256 (of little-endian unsigned 32-bit integers) and
    decoded_sha256 replace the text; with ``keep_ids``, the column ids comes before them. The
    steps share one Python worker.
    """
    ids, decoded = fresh(df.columns, "ids"), fresh(df.columns, "decoded")
    fields = [StructField(ids, ArrayType(IntegerType()))] if keep_ids else []
    fields += [
        StructField("n_tokens", LongType()),
        StructField("ids_sha256", StringType()),
        StructField("decoded_sha256", StringType()),
    ]

    dropped = [text, decoded] if keep_ids else [text, ids, decoded]

    def run(batches: Batches, codec: Codec) -> Batches:
        encoded = _encode(batches, codec, text, ids)
        return _digest(_decode(encoded, codec, ids, decoded), dropped, ids, decoded)

    return df.mapInArrow(
        lambda batches: _opened(vocabulary, lambda codec: run(batches, codec), sizes),
        _with(df.drop(text), *fields),
    )
