"""Token ids as flat unsigned integer files with 64-bit document offsets, memory-mapped when read.

Documents are dealt out by ranges of their id; each range becomes one shard of two files. A shard's first
token number is the sum of the counts of the shards before it. Files carry the attempt's name, and only those
named in the stored manifest count, so a task that runs twice does no harm.

Index file: 8 bytes of magic, then unsigned 64-bit width in bytes, number of documents, the offsets (one more
than documents), then the ids of the documents (signed 64-bit) and a byte each that is 1 for a null id.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillcast.llm.bpe import SPACE, vocabulary
from tillcast.llm.common import Remembered, chunks, drop_memories, give_back, keep_memory
from tillcast.session import materialise, scratch_path

MAGIC = b"TILLTOK1"
#: Documents that one reading step covers.
READ_DOCS = 20_000

#: Words of new text that the library gets at once, and in one line; bytes of text that a step of a task holds, bytes remembered.
BATCH = 10_000
LINE = 500
STEP_BYTES = 2_000_000
REMEMBERED = 96_000_000

#: White space but for the blank and the line feed.
RARE = [c for c in SPACE if c not in " \n"]
BORDER = re.compile(f"(?=[{SPACE}][^{SPACE}])")


class ByteEncoder:
    """Whole texts to ids by the tokenizers library; words seen before are not encoded again.

    A text is cut before each white space character that a visible one follows: there the vocabulary's own
    pattern always starts anew, so the ids of the pieces are the ids of the text.
    """

    def __init__(self, spec: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(spec)
        self.library.no_truncation()
        self.library.no_padding()
        size = self.library.get_vocab_size(with_added_tokens=True)
        self.width = 2 if size <= 1 << 16 else 4
        self.kind = np.dtype(f"<u{self.width}")
        tokens = self.library.get_vocab(with_added_tokens=True)
        added = {x.content for x in self.library.get_added_tokens_decoder().values()}
        self.sizes = np.zeros(max(tokens.values()) + 1, np.int64)
        for token, i in tokens.items():
            self.sizes[i] = len(token.encode()) if token in added else len(token)  # a letter of a token is a byte
        #: Ids of a word with the blank before it, or of one that starts with a line feed.
        self.known = Remembered(REMEMBERED, lambda word, ids: 190 + len(word) + len(ids))

    def _ids(self, pieces: list[str]) -> list[bytes]:
        found = self.library.encode_batch_fast(pieces, add_special_tokens=False) if pieces else []
        return [np.array(x.ids, self.kind).tobytes() for x in found]

    def _ids_of_words(self, words: list[str]) -> list[bytes]:
        """Ids of words that each begin with white space and end with a visible character.

        The library gets them in lines of many words; a line's ids are parted by the bytes that tokens stand for.
        """
        out: list[bytes] = []
        for at in range(0, len(words), BATCH):
            some = words[at:at + BATCH]
            lines = [some[i:i + LINE] for i in range(0, len(some), LINE)]
            for line, x in zip(lines, self.library.encode_batch_fast(["".join(ws) for ws in lines], add_special_tokens=False)):
                ids = np.array(x.ids, np.int64)
                ends = self.sizes[ids].cumsum()
                wanted = np.fromiter((len(w.encode()) for w in line), np.int64, len(line)).cumsum()
                last = np.searchsorted(ends, wanted)
                if not (ends[np.minimum(last, len(ends) - 1)] == wanted).all():
                    out += self._ids(line)
                    continue
                data, cuts = ids.astype(self.kind).tobytes(), [0, *((last + 1) * self.width).tolist()]
                out += [data[a:b] for a, b in zip(cuts, cuts[1:])]
        return out

    def _learn(self, words: set[str]) -> None:
        new = self.known.missing(words)
        odd = [w for w in new if w in ("", "\n")]
        asked = [w for w in new if w not in ("", "\n")]
        self.known.add(zip(asked, self._ids_of_words([w if w[0] == "\n" else " " + w for w in asked])))
        self.known.add(zip(odd, self._ids([w or " " for w in odd])))

    def encode(self, texts: list[str | None], end: int | None = 0) -> list[bytes]:
        """Ids of each text in this vocabulary's width, with ``end`` appended."""
        first, cut = [], []
        for t in texts:
            t = t or ""
            if "  " in t or "\n\n" in t or " \n" in t or "\n " in t or any(c in t for c in RARE):
                first.append(self._ids([p for p in BORDER.split(t) if p]))
                cut.append([])
            else:
                words = t.replace("\n", " \n").split(" ")
                first.append(words[:1])
                cut.append(words[1:])
        self._learn(set().union(*cut) if cut else set())
        opening = self._ids([f[0] if f and isinstance(f[0], str) else "" for f in first])
        look, tail = self.known.young.__getitem__, b"" if end is None else np.array([end], self.kind).tobytes()
        out = [
            b"".join((*(f if f and isinstance(f[0], bytes) else [o]), *map(look, ws), tail)) for f, o, ws in zip(first, opening, cut)
        ]
        self.known.settle()
        return out


_READY: dict[str, ByteEncoder] = {}


def byte_encoder(spec: str) -> ByteEncoder:
    key = hashlib.sha256(spec.encode()).hexdigest()
    if key not in _READY:
        _READY[key] = ByteEncoder(spec)
        keep_memory("tokens", _READY[key].known)
    return _READY[key]


def place(uri: str):
    """File system and path of a folder that all executors share."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


def write_tokens(
    docs: DataFrame, path: str, folder: str | None = None, key: str = "doc_id", column: str = "text",
    end: int | None = 0, shards: int | None = None,
) -> tuple[str, DataFrame]:
    """Writes the ids of every whole text in ascending order of ``key``; returns the folder and the manifest.

    A null text counts as empty, so only ``end`` is written. Null keys come first; rows with the same key
    follow each other in the order of their texts. The manifest has a row for each shard: its files, its first
    token and document, and its counts. An empty table gives an empty manifest.
    """
    spark = docs.sparkSession
    folder = folder or scratch_path(spark, "tokens")
    spec = spark.sparkContext.broadcast(vocabulary(path))
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = docs.select(F.col(key).cast("long").alias("key"), F.col(column).cast("string").alias("text"))
    dealt = dealt.repartitionByRange(shards, "key").sortWithinPartitions("key", "text")

    def run(batches):
        from pyspark import TaskContext

        system, top = place(folder)
        system.create_dir(top, recursive=True)
        context = TaskContext.get()
        name = f"shard-{context.partitionId():06d}-{context.attemptNumber()}-{uuid.uuid4().hex[:8]}"
        drop_memories("tokens")
        encoder = byte_encoder(spec.value)
        keys, empty, sizes = [], [], []
        out = None
        for batch in batches:
            for part in chunks(batch, "text", STEP_BYTES):
                out = out or system.open_output_stream(f"{top}/{name}.bin")
                found = encoder.encode(part.column(1).to_pylist(), end)
                out.write(b"".join(found))
                ids = part.column(0)
                keys.append(ids.fill_null(0).to_numpy(zero_copy_only=False))
                empty.append(ids.is_null().to_numpy(zero_copy_only=False))
                sizes.append(np.array([len(x) // encoder.width for x in found], np.uint64))
        give_back()
        if out is None:
            return
        out.close()
        sizes = np.concatenate(sizes)
        with system.open_output_stream(f"{top}/{name}.idx") as index:
            index.write(MAGIC + np.array([encoder.width, len(sizes)], "<u8").tobytes())
            index.write(np.concatenate(([0], sizes.cumsum())).astype("<u8").tobytes())
            index.write(np.concatenate(keys).astype("<i8").tobytes() + np.concatenate(empty).astype("u1").tobytes())
        yield pa.RecordBatch.from_pydict({
            "part": [context.partitionId()], "shard": [name], "docs": [len(sizes)], "tokens": [int(sizes.sum())],
        })

    written = materialise(dealt.mapInArrow(run, "part long, shard string, docs long, tokens long"), "token-shards")
    rows = sorted(written.collect(), key=lambda r: r.part)  # a row for each shard
    first_token = np.concatenate(([0], np.cumsum([r.tokens for r in rows]))).astype(int).tolist()
    first_doc = np.concatenate(([0], np.cumsum([r.docs for r in rows]))).astype(int).tolist()
    manifest = spark.createDataFrame(
        [(r.shard, r.docs, r.tokens, first_doc[i], first_token[i]) for i, r in enumerate(rows)],
        "shard string, docs long, tokens long, first_doc long, first_token long",
    )
    manifest.write.parquet(f"{folder}/manifest")
    return folder, spark.read.parquet(f"{folder}/manifest")


class Shard:
    """One shard: local files are memory-mapped, others are read by range."""

    def __init__(self, folder: str, name: str):
        from pyarrow import fs

        system, top = place(folder)
        path = f"{top}/{name}"
        with system.open_input_file(f"{path}.idx") as f:
            raw = f.read()
        if raw[:8] != MAGIC:
            raise ValueError(f"{path}.idx is no token index")
        width, n = np.frombuffer(raw, "<u8", 2, 8).tolist()
        self.offsets = np.frombuffer(raw, "<u8", n + 1, 24).astype(np.int64)
        self.keys = np.frombuffer(raw, "<i8", n, 24 + 8 * (n + 1))
        self.null = np.frombuffer(raw, "u1", n, 24 + 8 * (n + 1) + 8 * n).astype(bool)
        self.kind = np.dtype(f"<u{width}")
        self.map = np.memmap(f"{path}.bin", self.kind, "r") if isinstance(system, fs.LocalFileSystem) and self.offsets[-1] else None
        self.open = lambda: system.open_input_file(f"{path}.bin")

    def ids(self, first: int, last: int) -> np.ndarray:
        """The ids of documents ``first`` to ``last``, the last not included."""
        a, b = int(self.offsets[first]), int(self.offsets[last])
        if self.map is not None:
            return self.map[a:b]
        with self.open() as f:
            return np.frombuffer(f.read_at((b - a) * self.kind.itemsize, a * self.kind.itemsize), self.kind)


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """For each stored document: doc_id, start (tokens before it), n_tokens and ids_crc32, read from the files."""
    step = READ_DOCS
    parts = spark.read.parquet(f"{folder}/manifest").select(
        "shard", "first_token", F.explode(F.sequence(F.lit(0).cast("long"), F.col("docs") - 1, F.lit(step).cast("long"))).alias("first"), "docs",
    )
    n = max(1, parts.count())

    def run(frames):
        for frame in frames:
            for row in frame.itertuples():
                shard = Shard(folder, row.shard)
                last = min(row.first + step, row.docs)
                ends = shard.offsets[row.first:last + 1]
                for at in range(row.first, last, 256):
                    upto = min(at + 256, last)
                    ids, base = shard.ids(at, upto), ends[at - row.first]
                    cuts = (ends[at - row.first:upto - row.first + 1] - base).tolist()
                    sums = [zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in zip(cuts, cuts[1:])]
                    yield pa.RecordBatch.from_arrays([
                        pa.array(shard.keys[at:upto], mask=shard.null[at:upto]),
                        pa.array(ends[at - row.first:upto - row.first] + row.first_token),
                        pa.array(np.diff(cuts).astype(np.int64)), pa.array(sums, pa.int64()),
                    ], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    def arrow(batches):
        yield from run(b.to_pandas() for b in batches)

    return parts.repartition(n).mapInArrow(arrow, "doc_id long, start long, n_tokens long, ids_crc32 long")
