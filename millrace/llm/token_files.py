"""Token-id output: shard files of raw ids and a minimal perfect hash index over document keys.

Layout below one folder of the shared store:

``shard-<task>-<n>.ids``
    ``b"MRIDS2\\0\\0"``, item width in bytes (u32), then raw little-endian ids (u16 if the
    vocabulary allows it, else u32) of its documents in ascending key order; at the
    end the documents' lengths (u32 each), then number of ids, of documents and of
    null keys (u64 each).  A task streams its documents into shards of about
    ``SHARD_BYTES`` or ``SHARD_ROWS``, whichever is first; only a longer document
    makes a longer shard.
``index-<p>.mph``
    ``b"MRMPH2\\0\\0"``, number of slots, levels and left-over keys, the bits of each
    level, the left-over keys, then per level the bit array of a levelled minimal
    perfect hash (BBHash) and the rank before every 512th bit, then per slot: 64-bit
    fingerprint, shard, first row, row count, item offset, item count.
``files.json``
    the number of index files.

``get`` reads one key: it hashes the key, picks the index file, probes the levels
(about 1.6 probes, 64 bytes and a rank sample each), reads the slot, checks the
stored fingerprint and reads the ids' range: a constant number of ranged reads
whatever the files' sizes, and a key that was never indexed is refused but for
one in 2**64.

Rows with equal keys lie beside each other, in one shard or in several that
follow; the index holds their first row and their number.  Null keys are written
first and are read by scanning, not through the index.  Keys must be whole
numbers; texts that are null encode as empty: the end id only.  Repeated rows are
written each; an empty table makes no shard; other columns, whatever their names,
are ignored.

Files are written under a temporary name and renamed, so a repeated or
speculative task leaves the same bytes.
"""

from __future__ import annotations

import json
import posixpath
import re
import struct
import uuid
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import file_system, mix, put_file, shared_dir, written

END_ID = 0
SHARD_MAGIC, INDEX_MAGIC = b"MRIDS2\0\0", b"MRMPH2\0\0"
SHARD_BYTES, SHARD_ROWS, INDEX_KEYS = 64 << 20, 500_000, 200_000
#: Bits that a rank sample stands for; bytes that a reader of a shard holds at once.
SAMPLE, READ_BYTES = 512, 8 << 20
LEVELS, GAMMA = 24, 2.0
#: Distinct pieces of text whose ids a worker remembers.
MEMORY = 400_000


#: How a byte-level tokenizer cuts text before merging (fixed by the tokenizer's format).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: The same in the standard library's terms, for texts without the characters that the two class differently.
PLAIN = r"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+"


def _differing() -> frozenset[str]:
    """Characters that ``PATTERN`` and ``PLAIN`` class differently."""
    import regex

    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    odd: set[str] = set()
    for full, plain in ((r"\p{L}", r"[^\W\d_]"), (r"\p{N}", r"\d"), (r"\s", r"\s")):
        odd |= set(regex.findall(full, every)) ^ set(re.findall(plain, every))
    return frozenset(odd)


class Encoder(dict):
    """Encodes whole texts with the tokenizers library; maps pieces of text to the bytes of their ids.

    A byte-level tokenizer cuts text by a fixed pattern before it merges bytes,
    so equal pieces get equal ids wherever they stand; each distinct piece goes
    through the library's model once.  Texts that hold an added token's string,
    and any other kind of tokenizer, go through the whole library.
    """

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        spec = json.loads(self.tokenizer.to_str())
        pre = spec.get("pre_tokenizer") or {}
        self.by_piece = pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True) and not spec.get("normalizer")
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.kind = f"<u{self.width}"
        if self.by_piece:
            self.any_split, self.plain_split = regex.compile(PATTERN).findall, re.compile(PLAIN).findall
            self.odd = _differing()
            self.added = [t["content"] for t in spec.get("added_tokens", [])]
            shown = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves in the vocabulary
            others = [b for b in range(256) if b not in shown]
            self.byte_chars = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(others)}

    def __missing__(self, piece: str) -> bytes:
        ids = [t.id for t in self.tokenizer.model.tokenize("".join(map(self.byte_chars.__getitem__, piece.encode("utf-8"))))]
        self[piece] = out = np.array(ids, self.kind).tobytes()
        return out

    def encode(self, text: str) -> bytes:
        """Little-endian ids of the text."""
        if not self.by_piece or any(a in text for a in self.added):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.kind).tobytes()
        if len(self) > MEMORY:
            self.clear()
        plain = self.odd.isdisjoint(set(text))
        return b"".join(map(self.__getitem__, (self.plain_split if plain else self.any_split)(text)))


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def key_hash(keys: np.ndarray, seed: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(keys.astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed * 2 + 1) * np.uint64(0xC2B2AE3D27D4EB4F))


class PerfectHash:
    """Levelled minimal perfect hash over distinct 64-bit keys."""

    def __init__(self, levels: list[np.ndarray], rest: np.ndarray):
        self.levels, self.rest = levels, rest
        counts = np.cumsum([0, *[int(x.sum()) for x in levels]])
        self.base, self.size = counts, int(counts[-1]) + len(rest)
        self.rank = [np.concatenate([[0], np.cumsum(x, dtype=np.int64)]) for x in levels]

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        levels, left = [], keys
        for level in range(LEVELS):
            if not len(left):
                break
            n = max(64, int(GAMMA * len(left)))
            at = (key_hash(left, level) % np.uint64(n)).astype(np.int64)
            bits = np.bincount(at, minlength=n) == 1
            levels.append(bits)
            left = left[~bits[at]]
        return cls(levels, np.sort(left))

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each key; -1 where a key is surely not indexed."""
        out = np.full(len(keys), -1, np.int64)
        todo = np.arange(len(keys))
        for level, bits in enumerate(self.levels):
            at = (key_hash(keys[todo], level) % np.uint64(len(bits))).astype(np.int64)
            hit = bits[at]
            out[todo[hit]] = self.base[level] + self.rank[level][at[hit]]
            todo = todo[~hit]
        if len(self.rest) and len(todo):
            at = np.searchsorted(self.rest, keys[todo])
            ok = (at < len(self.rest)) & (self.rest[np.minimum(at, len(self.rest) - 1)] == keys[todo])
            out[todo[ok]] = self.base[-1] + at[ok]
        return out

    def dump(self) -> bytes:
        out = [struct.pack("<III", self.size, len(self.levels), len(self.rest)), np.array([len(x) for x in self.levels], "<u4").tobytes(), self.rest.astype("<i8").tobytes()]
        for level, bits in enumerate(self.levels):
            padded = np.concatenate([bits, np.zeros(-len(bits) % SAMPLE, bool)])
            out += [np.packbits(padded).tobytes(), (self.base[level] + self.rank[level][: len(bits) : SAMPLE]).astype("<u4").tobytes()]
        return b"".join(out)

    @classmethod
    def load(cls, data: bytes, at: int) -> tuple[PerfectHash, int]:
        _, n, rest = struct.unpack_from("<III", data, at)
        sizes = np.frombuffer(data, "<u4", n, at + 12)
        at += 12 + 4 * n
        kept = np.frombuffer(data, "<i8", rest, at)
        at += 8 * rest
        levels = []
        for size in sizes.tolist():
            blocks = -(-size // SAMPLE)
            levels.append(np.unpackbits(np.frombuffer(data, np.uint8, blocks * SAMPLE // 8, at), count=size).astype(bool))
            at += blocks * (SAMPLE // 8 + 4)
        return cls(levels, kept), at


SLOT = np.dtype([("print", "<u8"), ("shard", "<u8"), ("row", "<u4"), ("rows", "<u8"), ("offset", "<u8"), ("count", "<u8")])
PRINT_SEED = 977


def index_bytes(keys: np.ndarray, **values: np.ndarray) -> bytes:
    table = PerfectHash.build(keys)
    slots = np.zeros(table.size, SLOT)
    at = table.slots(keys)
    for name, v in ({"print": key_hash(keys, PRINT_SEED)} | values).items():
        slots[name][at] = v
    return INDEX_MAGIC + table.dump() + slots.tobytes()


class Index:
    """One index file."""

    def __init__(self, data: bytes):
        if data[:8] != INDEX_MAGIC:
            raise ValueError("not an index file")
        self.hash, at = PerfectHash.load(data, 8)
        self.slots = np.frombuffer(data, SLOT, self.hash.size, at)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(found, slot records) of ``keys``; a stored fingerprint must agree."""
        at = self.hash.slots(keys)
        records = self.slots[np.maximum(at, 0)] if len(self.slots) else np.zeros(len(keys), SLOT)
        return (at >= 0) & (records["print"] == key_hash(keys, PRINT_SEED)), records


def fetch(folder: str, name: str) -> bytes:
    system, path = file_system(folder)
    with system.open_input_stream(f"{path}/{name}") as f:
        return f.read()


def index_of(keys: np.ndarray, files: int) -> np.ndarray:
    return (key_hash(keys, 4242) % np.uint64(files)).astype(np.int64)


def shard_name(shard: int) -> str:
    return f"shard-{shard >> 32:06d}-{shard & 0xFFFFFFFF:06d}.ids"


class Shards:
    """Streams a task's documents into shard files, one open at a time."""

    def __init__(self, folder: str, task: int, width: int, most_bytes: int, most_rows: int):
        (self.system, self.folder), self.width = file_system(folder), width
        self.most_items, self.most_rows = most_bytes // width, most_rows
        self.shard, self.out, self.lengths = task << 32, None, []

    def add(self, ids: bytes, null_key: bool) -> tuple[int, int, int]:
        """(shard, row, offset) of a document's ids."""
        if self.out is not None and (self.items >= self.most_items or len(self.lengths) >= self.most_rows):
            self.close()
            self.shard += 1
        if self.out is None:
            self.system.create_dir(self.folder, recursive=True)
            self.final = posixpath.join(self.folder, shard_name(self.shard))
            self.attempt = f"{self.final}.{uuid.uuid4().hex[:8]}.part"
            self.out = self.system.open_output_stream(self.attempt, compression=None, buffer_size=1 << 20)
            self.out.write(SHARD_MAGIC + struct.pack("<I", self.width))
            self.items, self.nulls, self.lengths = 0, 0, []
        place = (self.shard, len(self.lengths), self.items)
        self.out.write(ids)
        self.lengths.append(len(ids) // self.width)
        self.items += self.lengths[-1]
        self.nulls += null_key
        return place

    def close(self) -> None:
        if self.out is not None:
            self.out.write(np.array(self.lengths, "<u4").tobytes() + struct.pack("<QQQ", self.items, len(self.lengths), self.nulls))
            self.out.close()
            self.system.move(self.attempt, self.final)
            self.out = None


class Shard:
    """Reads ranges of one shard file."""

    def __init__(self, folder: str, shard: int):
        system, path = file_system(folder)
        self.file = system.open_input_file(f"{path}/{shard_name(shard)}")
        head, end = self.file.read_at(12, 0), self.file.size()
        if head[:8] != SHARD_MAGIC:
            raise ValueError("not a shard file")
        self.width = struct.unpack_from("<I", head, 8)[0]
        self.items, self.rows, self.nulls = struct.unpack("<QQQ", self.file.read_at(24, end - 24))

    def __enter__(self) -> Shard:
        return self

    def __exit__(self, *_) -> None:
        self.file.close()

    def lengths(self) -> np.ndarray:
        return np.frombuffer(self.file.read_at(4 * self.rows, 12 + self.items * self.width), "<u4").astype(np.int64)

    def ids(self, offset: int, count: int) -> np.ndarray:
        return np.frombuffer(self.file.read_at(count * self.width, 12 + offset * self.width), f"<u{self.width}")


def write(docs: DataFrame, folder: str, tokenizer: str, key: str = "doc_id", text: str = "text", shard_bytes: int = SHARD_BYTES, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Encode ``docs`` into shard files in ascending key order; returns the manifest (key, shard, row, offset, n_tokens)."""
    if not isinstance(docs.schema[key].dataType, T.IntegralType):
        raise TypeError(f"{key} must be a whole number, not {docs.schema[key].dataType.simpleString()}")

    def encode(batches):
        from pyspark import TaskContext

        enc = encoder(tokenizer)
        shards, end = Shards(folder, TaskContext.get().partitionId(), enc.width, shard_bytes, shard_rows), np.array([END_ID], enc.kind).tobytes()
        for batch in batches:
            nulls, places, lengths = batch.column(0).is_null().to_pylist(), [], []
            for t, null in zip(batch.column(1).to_pylist(), nulls, strict=True):
                ids = enc.encode(t or "") + end
                places.append(shards.add(ids, null))
                lengths.append(len(ids) // enc.width)
            shard, row, offset = (pa.array(x, pa.int64()) for x in zip(*places, strict=True)) if places else [pa.array([], pa.int64())] * 3
            yield pa.record_batch([batch.column(0), shard, row, offset, pa.array(lengths, pa.int64())], names=["key", "shard", "row", "offset", "n_tokens"])
        shards.close()

    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    rows = rows.repartitionByRange("key", F.xxhash64("text")).sortWithinPartitions("key", F.xxhash64("text"))
    return written(rows.select("key", "text").mapInArrow(encode, "key long, shard long, row long, offset long, n_tokens long"), "token-manifest")


_FIRST = ("shard", "row", "rows", "offset", "n_tokens")


def build_index(manifest: DataFrame, folder: str, keys_a_file: int = INDEX_KEYS) -> None:
    """Write one minimal perfect hash index file for each of so many hash ranges that a file holds about ``keys_a_file`` keys."""
    first = F.min(F.struct("shard", "row", "offset", "n_tokens")).alias("first")
    keys = manifest.where("key IS NOT NULL").groupBy("key").agg(first, F.count(F.lit(1)).alias("rows"))
    files = manifest.count() // keys_a_file + 1

    def one(batches):
        for batch in batches:
            k = batch.column("key").to_numpy(zero_copy_only=False)
            yield pa.record_batch([pa.array(index_of(k, files).astype(np.int32)), *[batch.column(c) for c in ("key", *_FIRST)]], names=["part", "key", *_FIRST])

    def save(group: pa.Table) -> pa.Table:
        k, shard, row, rows, offset, count = (group.column(x).to_numpy() for x in ("key", *_FIRST))
        part = group.column("part")[0].as_py()
        put_file(folder, f"index-{part:06d}.mph", index_bytes(k, shard=shard, row=row, rows=rows, offset=offset, count=count))
        return pa.table({"part": pa.array([part], pa.int32()), "keys": pa.array([len(k)], pa.int64())})

    flat = keys.select("key", "first.shard", "first.row", "rows", "first.offset", "first.n_tokens")
    dealt = flat.mapInArrow(one, "part int, key long, shard long, row long, rows long, offset long, n_tokens long")
    dealt.groupBy("part").applyInArrow(save, "part int, keys long").agg(F.sum("keys")).collect()
    put_file(folder, "files.json", json.dumps({"index_files": files}).encode())


def index_files(folder: str) -> int:
    return json.loads(fetch(folder, "files.json"))["index_files"]


def lookup(keys: DataFrame, folder: str) -> DataFrame:
    """(key, shard, row, rows, offset, n_tokens) of each row of ``keys`` (column ``key``) that the index knows."""
    files = index_files(folder)

    def deal(batches):
        for batch in batches:
            k = batch.column("key").to_numpy(zero_copy_only=False)
            yield pa.record_batch([pa.array(index_of(k, files).astype(np.int32)), batch.column("key")], names=["part", "key"])

    def find(group: pa.Table) -> pa.Table:
        name = f"index-{group.column('part')[0].as_py():06d}.mph"
        k = group.column("key").to_numpy()
        system, path = file_system(folder)
        data = fetch(folder, name) if system.get_file_info(f"{path}/{name}").is_file else index_bytes(np.zeros(0, np.int64))
        ok, slot = Index(data).find(k)
        at = slot[ok]
        return pa.table({"key": k[ok]} | {n: at["count" if n == "n_tokens" else n].astype(np.int64) for n in _FIRST})

    dealt = keys.where("key IS NOT NULL").select("key").mapInArrow(deal, "part int, key long")
    return dealt.groupBy("part").applyInArrow(find, "key long, shard long, row long, rows long, offset long, n_tokens long")


def get(folder: str, key: int) -> list[np.ndarray] | None:
    """The ids of each row of ``key``, by a constant number of ranged reads a row; None for a key that is not indexed."""
    system, path = file_system(folder)
    k = np.array([key], np.int64)
    name = f"{path}/index-{index_of(k, index_files(folder))[0]:06d}.mph"
    if not system.get_file_info(name).is_file:
        return None
    with system.open_input_file(name) as f:
        size, n, rest = struct.unpack("<III", f.read_at(12, 8))
        bits = np.frombuffer(f.read_at(4 * n, 20), "<u4").tolist()
        kept, at = 20 + 4 * n, 20 + 4 * n + 8 * rest
        slot = None
        for level, m in enumerate(bits):
            blocks = -(-m // SAMPLE)
            block, bit = divmod(int(key_hash(k, level)[0] % np.uint64(m)), SAMPLE)
            if slot is None:
                ones = np.unpackbits(np.frombuffer(f.read_at(SAMPLE // 8, at + block * (SAMPLE // 8)), np.uint8))
                if ones[bit]:
                    (rank,) = struct.unpack("<I", f.read_at(4, at + blocks * (SAMPLE // 8) + 4 * block))
                    slot = rank + int(ones[:bit].sum())
            at += blocks * (SAMPLE // 8 + 4)
        if slot is None and rest:  # the keys left over after the last level: hardly ever any
            left = np.frombuffer(f.read_at(8 * rest, kept), "<i8")
            i = int(np.searchsorted(left, key))
            slot = size - rest + i if i < rest and left[i] == key else None
        if slot is None:
            return None
        found = np.frombuffer(f.read_at(SLOT.itemsize, at + slot * SLOT.itemsize), SLOT)[0]
    if found["print"] != key_hash(k, PRINT_SEED)[0]:
        return None
    shard, row, left = int(found["shard"]), int(found["row"]), int(found["rows"]) - 1
    with Shard(folder, shard) as s:
        out = [s.ids(int(found["offset"]), int(found["count"]))]
    while left:  # rows that repeat the key follow, in this shard and the next ones
        with Shard(folder, shard) as s:
            lengths = s.lengths()
            starts = np.cumsum(lengths) - lengths
            more = range(row + 1, min(row + 1 + left, s.rows))
            out += [s.ids(int(starts[i]), int(lengths[i])) for i in more]
            left -= len(more)
        if left:
            shards = shards_of(folder)
            shard, row = shards[shards.index(shard) + 1], -1
    return out


def shards_of(folder: str) -> list[int]:
    """The shards below ``folder``, in order."""
    from pyarrow import fs

    system, path = file_system(folder)
    names = [x.base_name for x in system.get_file_info(fs.FileSelector(path, allow_not_found=True))]
    return sorted((int(n[6:-4].split("-")[0]) << 32) + int(n[6:-4].split("-")[1]) for n in names if n.startswith("shard-") and n.endswith(".ids"))


def shard_totals(spark, folder: str) -> list[tuple[int, int, int, int]]:
    """(shard, ids, documents, null keys) of every shard, from the shards' ends, in order: one small row a shard."""
    shards = shards_of(folder)
    if not shards:
        return []

    def ends(batches):
        for batch in batches:
            for shard in batch.column(0).to_pylist():
                with Shard(folder, shard) as s:
                    yield pa.record_batch([pa.array([x], pa.int64()) for x in (shard, s.items, s.rows, s.nulls)], names=["shard", "n", "rows", "nulls"])

    some = spark.createDataFrame([(s,) for s in shards], "shard long").repartition(max(1, min(len(shards) // 16, 1000)))
    return sorted(tuple(r) for r in some.mapInArrow(ends, "shard long, n long, rows long, nulls long").collect())


def _stretches(totals: list[tuple[int, int, int, int]]):
    """(key, shard, row, rows, offset, n_tokens) with the rows of a key cut at the shards' ends; offset -1 where only the shard tells it."""
    shards, rows = np.array([t[0] for t in totals]), np.array([t[2] for t in totals])

    def run(batches):
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                i = int(np.searchsorted(shards, r["shard"]))
                row, left, offset = r["row"], r["rows"], r["offset"]
                while left > 0:
                    n = int(min(left, rows[i] - row))
                    out.append((r["key"], int(shards[i]), row, n, offset, r["n_tokens"] if n == 1 and offset >= 0 else -1))
                    left, i, row, offset = left - n, i + 1, 0, -1
            yield pa.record_batch([pa.array(c, pa.int64()) for c in zip(*out, strict=True)] if out else [pa.array([], pa.int64())] * 6, names=["key", *_FIRST])

    return run


def payloads(found: DataFrame, folder: str) -> DataFrame:
    """(key, shard, offset, n_tokens, ids_crc32 of the u32 ids) of every row of looked-up stretches (key, shard, row, rows, offset, n_tokens), read in ranges."""

    def read(group: pa.Table) -> pa.Table:
        keys, offsets, counts = [], [], []
        with Shard(folder, group.column("shard")[0].as_py()) as shard:
            lengths = None
            for k, row, rows, offset, count in zip(*(group.column(c).to_pylist() for c in ("key", "row", "rows", "offset", "n_tokens")), strict=True):
                if rows == 1 and count >= 0:
                    keys.append(k), offsets.append(offset), counts.append(count)
                    continue
                if lengths is None:
                    lengths = shard.lengths()
                    starts = np.cumsum(lengths) - lengths
                keys += [k] * rows
                offsets += starts[row : row + rows].tolist()
                counts += lengths[row : row + rows].tolist()
            order = np.argsort(np.array(offsets, np.int64), kind="stable").tolist()
            crc, buffer, begin, stop = [0] * len(keys), None, 0, 0
            for i in order:
                o, n = offsets[i], counts[i]
                if o + n > stop or o < begin:
                    begin, stop = o, o + max(n, min(READ_BYTES // shard.width, shard.items - o))
                    buffer = shard.ids(begin, stop - begin)
                crc[i] = zlib.crc32(buffer[o - begin : o - begin + n].astype("<u4").tobytes())
        columns = {"key": keys, "shard": group.column("shard")[:1].to_pylist() * len(keys), "offset": offsets, "n_tokens": counts, "ids_crc32": crc}
        return pa.table({n: pa.array(c, pa.int64()) for n, c in columns.items()})

    return found.groupBy("shard").applyInArrow(read, "key long, shard long, offset long, n_tokens long, ids_crc32 long")


def read_keys(keys: DataFrame, folder: str, nulls: bool = False) -> DataFrame:
    """(key, start, n_tokens, ids_crc32) of every row of the ``keys`` (column ``key``) that the index knows, and of the rows without a key if ``nulls``; all from the files."""
    spark = keys.sparkSession
    totals = shard_totals(spark, folder)
    if not totals:
        return spark.createDataFrame([], "key long, start long, n_tokens long, ids_crc32 long")
    bases, at = [], 0
    for shard, n, _, _ in totals:
        bases.append((shard, at))
        at += n
    found = lookup(keys.select("key").distinct(), folder).mapInArrow(_stretches(totals), "key long, shard long, row long, rows long, offset long, n_tokens long")
    empty = [(None, shard, 0, n, -1, -1) for shard, _, _, n in totals if n]
    if nulls and empty:
        found = found.union(spark.createDataFrame(empty, found.schema))
    bases = spark.createDataFrame(bases, "shard long, base long")  # one row a shard
    bases = F.broadcast(bases) if len(totals) <= 100_000 else bases
    return payloads(found, folder).join(bases, "shard").select("key", (F.col("base") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32")


def encode_and_read(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Write ``docs`` as shards with an index, look every document up again and digest what the files hold."""
    folder = shared_dir(docs.sparkSession, "token-files")
    manifest = write(docs, folder, tokenizer)
    build_index(manifest, folder)
    return read_keys(manifest.select("key"), folder, nulls=True).withColumnRenamed("key", "doc_id")


def op2_token_files(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return encode_and_read(docs, public_tokenizers.path("byte_bpe_50k.json"))
