"""Token ids of whole texts in files of independent, checksummed, range-coded blocks.

Documents are range-partitioned by id, so that every partition is one run of the global order. A file row is
a segment: consecutive documents whose ids are coded in blocks of 4096, behind the counts of its ids. Files are Parquet tables of segments,
written and read by Spark wherever the cluster keeps its files.
"""

from __future__ import annotations

import array
import functools
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from basketlake.llm import rangecoder
from basketlake.llm.common import scratch

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
END_ID = 2
#: Ids a segment holds, unless one document alone has more. Whole segments are coded in lockstep.
SEGMENT_IDS = 8_000_000
#: Bytes of texts that are cut into chunks and looked up at a time, unless one text alone has more.
SLICE_BYTES = 2 << 20
#: Classes of bytes: white space that parts chunks, letters, other visible ASCII, and first bytes of what may be other white space.
_SPACE, _LETTER, _SIGN, _RARE = 1, 2, 4, 8
_CLASS = np.zeros(256, np.uint8)
_CLASS[[9, 11, 12, 13, 28, 29, 30, 31, 0xC2, 0xE1, 0xE2, 0xE3]] = _RARE
_CLASS[[10, 32]] = _SPACE
_CLASS[[*range(65, 91), *range(97, 123)]] = _LETTER
_CLASS[[i for i in range(33, 127) if not chr(i).isalpha()]] = _SIGN
#: Chunks that may stand in one text with others.
_JOINS = re.compile(rb"[\n !-~\xC3].{0,62}[!-~]|[!-~]", re.DOTALL)
_OTHER_SPACE = re.compile(r"[^\S \n]")


def _borders(data: np.ndarray) -> np.ndarray:
    """Before which bytes of UTF-8 text a chunk begins, the first one left out.

    No piece of the pre-tokenizer reaches across these borders, nor looks at what is before them: before white space that
    follows a visible character, after a line feed that stands alone, and between an ASCII letter, or one of two bytes from C3,
    and another visible ASCII character, except between an apostrophe and a letter. Only spaces and line feeds may be white space.
    """
    kind = _CLASS[data]
    before, after = kind[:-1], kind[1:]
    latin = np.zeros(len(data), bool)
    # A second byte after C3 ends a letter, the signs of times (97) and division (B7) left out.
    np.logical_and(data[:-1] == 0xC3, (data[1:] & 0xDF) != 0x97, out=latin[1:])
    space, letter = kind == _SPACE, kind == _LETTER
    sign = kind == _SIGN
    cut = space[1:] & ~space[:-1]
    cut[1:] |= (data[1:-1] == 10) & ~space[2:] & ~space[:-2]
    cut |= (letter | latin)[:-1] & sign[1:]
    cut |= sign[:-1] & letter[1:] & (data[:-1] != 39)
    return cut


class Encoder:
    """``Tokenizer.encode`` of whole texts, with the ids of short chunks that recur remembered.

    Texts are cut by numpy and Arrow at borders that the pre-tokenizer never crosses, so the ids of a text are those
    of its chunks; every different chunk of a slice is looked up once, and the library encodes those not met before. A text
    with other white space or an added token is one chunk. Ids are kept as the bytes of 32-bit integers.
    """

    def __init__(self, path: str, remember: int = 300_000, longest: int = 64):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        # Tokens are written with one character a byte.
        self.widths = np.zeros(1 + max(self.tokenizer.get_vocab().values()), np.int64)
        for token, i in self.tokenizer.get_vocab().items():
            self.widths[i] = len(token)
        #: Chunks met since the last turn, and before it: those not met again in as many others are forgotten.
        self.known: dict[bytes, bytes] = {}
        self.before: dict[bytes, bytes] = {}
        self.remember, self.longest = remember, longest

    def _encode(self, chunks: list[bytes]) -> list[bytes]:
        """Ids of some chunks. Those with visible ends are encoded as one text, apart by white space, and told apart by the bytes that ids stand for."""
        out: list[bytes] = [b""] * len(chunks)
        joined = [i for i, c in enumerate(chunks) if _JOINS.fullmatch(c)]
        alone = sorted({*range(len(chunks))}.difference(joined))
        for i, e in zip(alone, self.tokenizer.encode_batch_fast([chunks[i].decode() for i in alone], add_special_tokens=False), strict=True):
            out[i] = array.array("I", e.ids).tobytes()
        if joined:
            # A line feed before a chunk that begins with no white space is one id, which is skipped.
            skip = np.array([chunks[i][0] > 32 for i in joined])
            parts = [b"\n" + chunks[i] if s else chunks[i] for i, s in zip(joined, skip.tolist(), strict=True)]
            ids = np.array(self.tokenizer.encode_batch_fast([b"".join(parts).decode()], add_special_tokens=False)[0].ids, "<u4")
            ends = np.cumsum([len(p) for p in parts])
            at = np.searchsorted(np.cumsum(self.widths[ids]), ends) + 1
            data, last = ids.tobytes(), (at * 4).tolist()
            first = (4 * (np.append(0, at[:-1]) + skip)).tolist()
            for i, a, b in zip(joined, first, last, strict=True):
                out[i] = data[a:b]
        return out

    def _ids(self, chunks: list[bytes]) -> list[bytes]:
        found = [*map(self.known.get, chunks)]
        missed = [i for i, x in enumerate(found) if x is None]
        again = [*map(self.before.get, [chunks[i] for i in missed])]
        new = []
        for i, x in zip(missed, again, strict=True):
            if x is None:
                new.append(i)
            else:
                found[i] = self.known[chunks[i]] = x
        for k in range(0, len(new), 5_000):
            part = new[k : k + 5_000]
            keys = [chunks[i] for i in part]
            ids = self._encode(keys)
            for i, x in zip(part, ids, strict=True):
                found[i] = x
            self.known.update((c, x) for c, x in zip(keys, ids, strict=True) if len(c) <= self.longest)
            if len(self.known) > self.remember:
                self.known, self.before = {}, self.known
        return found

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, how many of them each has); null has none."""
        texts = texts.cast(pa.large_string()).fill_null("")
        ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]] if len(texts) else np.zeros(0, np.uint8)
        ends = ends - ends[0]
        if not len(data):
            return np.zeros(0, "<u4"), np.zeros(len(texts), np.int64)
        begins = np.zeros(len(data), bool)
        begins[1:] = _borders(data)
        begins[ends[:-1][ends[:-1] < len(data)]] = True
        rare = np.unique(np.searchsorted(ends, np.flatnonzero(_CLASS[data] == _RARE), side="right") - 1).tolist()
        whole = {i for i in rare if _OTHER_SPACE.search(texts[i].as_py())}
        for a in self.added:
            whole.update(np.flatnonzero(pc.match_substring(texts, a).to_numpy(zero_copy_only=False)).tolist())
        for i in whole:
            begins[ends[i] + 1 : ends[i + 1]] = False
        starts = np.flatnonzero(begins)
        at = np.append(starts, len(data))
        chunks = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(at), pa.py_buffer(data)]).dictionary_encode()
        out = pa.array(self._ids(chunks.dictionary.to_pylist()), pa.large_binary()).take(chunks.indices)
        bounds = np.frombuffer(out.buffers()[1], np.int64)[: len(starts) + 1] >> 2
        ids = np.frombuffer(out.buffers()[2] or b"", "<u4")[: bounds[-1]]
        return ids, np.diff(bounds[np.searchsorted(at, ends)])

    def slices(self, texts: pa.Array, slice_bytes: int = SLICE_BYTES) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The same, some texts at a time."""
        sizes = np.cumsum(np.append(0, pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)))
        i = 0
        while i < len(texts):
            n = max(1, int(np.searchsorted(sizes, sizes[i] + slice_bytes, side="right")) - 1 - i)
            yield self(texts.slice(i, n))
            i += n


@functools.cache
def encoder(path: str) -> Encoder:
    """One for each worker process: the next task finds what the last one remembered."""
    return Encoder(path)


def _segments(path: str, end_id: int, segment_ids: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, before = encoder(path), TaskContext.get().partitionId(), 0
        width = np.min_scalar_type(max(len(encode.widths) - 1, end_id))
        docs: list = []
        ids: list[np.ndarray] = []
        sizes: list[np.ndarray] = []
        held = 0

        def flush():
            nonlocal docs, ids, sizes, held, before
            every, lens = np.concatenate(ids), np.concatenate(sizes)
            ids = []
            model, blocks = rangecoder.encode(every)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([part], pa.int32()), pa.array([before], pa.int64()), pa.array([len(every)], pa.int64()), pa.array([docs], pa.list_(kind)), pa.array([lens], pa.list_(pa.int64())),
                    pa.array([[b[0] for b in blocks]], pa.list_(pa.int32())), pa.array([[b[1] for b in blocks]], pa.list_(pa.int64())), pa.array([[b[2] for b in blocks]], pa.list_(pa.binary())), pa.array([model], pa.binary()),
                ],
                ["part", "before", "n_ids", "doc_ids", "n_tokens", "block_ids", "block_crc", "blocks", "model"],
            )
            before += len(every)
            docs, ids, sizes, held = [], [], [], 0

        for b in batches:
            kind, row = b.schema.field(0).type, 0
            for x, lens in encode.slices(b.column(1)):
                # With the end ids: one after each text.
                x, lens = np.insert(x.astype(width), np.cumsum(lens), end_id), lens + 1
                ends, first = np.cumsum(lens), 0
                while first < len(lens):
                    begin = int(ends[first] - lens[first])
                    n = int(np.searchsorted(ends, begin + segment_ids - held, side="right")) - first
                    if n <= 0:
                        if docs:
                            yield from flush()
                            continue
                        n = 1
                    docs += b.column(0).slice(row + first, n).to_pylist()
                    sizes.append(lens[first : first + n])
                    ids.append(x[begin : ends[first + n - 1]])
                    held += int(ends[first + n - 1]) - begin
                    first += n
                row += len(lens)
        if docs:
            yield from flush()

    return run


def write_tokens(docs: DataFrame, folder: str, tokenizer: str = TOKENIZER, end_id: int = END_ID, segment_ids: int = SEGMENT_IDS) -> None:
    """Encodes ``docs`` in ascending doc_id order (null ids first, equal ids by their text's hash) into ``folder``."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", "text").withColumn("_th", F.xxhash64("text"))
    rows = rows.repartitionByRange(parts, "doc_id", "_th").sortWithinPartitions("doc_id", "_th").select("doc_id", "text")
    schema = f"part int, before bigint, n_ids bigint, doc_ids array<{kind}>, n_tokens array<bigint>, block_ids array<int>, block_crc array<bigint>, blocks array<binary>, model binary"
    rows.mapInArrow(_segments(tokenizer, end_id, segment_ids), schema).write.option("compression", "none").parquet(folder)


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, part, at, n_tokens, ids_crc32) of every document in ``folder``, from its decoded blocks; ``at`` counts within the part."""
    files = spark.read.parquet(folder)
    kind = files.schema["doc_ids"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in range(b.num_rows):
                row = {k: b.column(k)[r].as_py() for k in b.schema.names}
                every = np.concatenate(rangecoder.decode(row["model"], list(zip(row["block_ids"], row["block_crc"], row["blocks"], strict=True))))
                ends = np.cumsum(row["n_tokens"])
                crcs = [zlib.crc32(every[e - n : e].tobytes()) for e, n in zip(ends.tolist(), row["n_tokens"], strict=True)]
                n = len(ends)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["doc_ids"], b.schema.field("doc_ids").type.value_type), pa.array(np.full(n, row["part"], np.int32)), pa.array(row["before"] + ends - np.array(row["n_tokens"], np.int64)), pa.array(row["n_tokens"], pa.int64()), pa.array(crcs, pa.int64())],
                    ["doc_id", "part", "at", "n_tokens", "ids_crc32"],
                )

    return files.select("part", "before", "doc_ids", "n_tokens", "block_ids", "block_crc", "blocks", "model").mapInArrow(run, f"doc_id {kind}, part int, at bigint, n_tokens bigint, ids_crc32 bigint")


def token_digest(docs: DataFrame, tokenizer: str = TOKENIZER, end_id: int = END_ID) -> DataFrame:
    """One row per document row: doc_id, start, n_tokens, ids_crc32, read back from the files written.

    Null and empty texts hold the end id alone; repeated rows are documents of their own; an empty table gives
    no rows. Only doc_id and text are read.
    """
    spark = docs.sparkSession
    folder = scratch(spark, "tokens")
    write_tokens(docs, folder, tokenizer, end_id)
    totals = spark.read.parquet(folder).groupBy("part").agg(F.sum("n_ids").alias("_n"))
    # One row per part, so the sums over all parts before are a window without keys.
    before = F.coalesce(F.sum("_n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("bigint"))
    offsets = totals.select(F.col("part").alias("_p"), before.alias("_off"))
    return read_tokens(spark, folder).join(F.broadcast(offsets), F.expr("part = _p")).select("doc_id", (F.col("_off") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")
