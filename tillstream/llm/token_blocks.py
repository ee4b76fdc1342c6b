"""Token files: ids of documents in patched frame-of-reference blocks.

A file is a sequence of little-endian 32-bit words:

    magic, version, range partition, file number in it, documents, ids (2 words), blocks,
    bytes of the document table, the document table (an Arrow stream of id and number of ids),
    block starts (words from the first block), the blocks.

A block holds 128 ids (the last one may hold fewer): the least id, then width | exceptions << 8 |
ids << 16, then the ids less the least one packed at ``width`` bits, then the exceptions' values and
their positions as bytes. The width is the one that 90 % of the block's values fit in.
"""

from __future__ import annotations

import json
import os
import re
import string
import unicodedata
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillstream.session import shared_folder

from .common import driver_table, give_back, lists, small_batches, stored

MAGIC = 0x524F4650  # "PFOR"
VERSION = 1
BLOCK = 128
PERCENTILE = 0.9
#: Ids after which a file ends.
FILE_IDS = 1 << 20
#: Blocks that are packed or unpacked at a time.
STEP = 1_024
END_ID = 2
#: Bytes of the texts whose words are looked up at a time; most batches hold less.
GROUP = 3_000_000
#: How a tokenizer changes and cuts texts if it takes lower-case letters between spaces as they are.
PLAIN = {
    "normalizer": {
        "type": "Sequence",
        "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}],
    },
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {
                "type": "Split",
                "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"},
                "behavior": "Removed",
                "invert": True,
            },
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
}


def bit_lengths(values: np.ndarray) -> np.ndarray:
    return np.frexp(values.astype(np.float64))[1].astype(np.int64)


def pack(values: np.ndarray, width: int) -> np.ndarray:
    """Rows of 128 numbers below 2**width as rows of 4 * width words."""
    # One place of all lanes after the other, so that each step reads and writes what lies together.
    places = np.ascontiguousarray(values.astype(np.uint32).reshape(-1, 32).T)
    out = np.zeros((width, places.shape[1]), np.uint32)
    for i in range(32):
        word, shift = divmod(i * width, 32)
        out[word] |= places[i] << np.uint32(shift)
        if shift + width > 32:
            out[word + 1] |= places[i] >> np.uint32(32 - shift)
    return np.ascontiguousarray(out.T).reshape(-1, 4 * width)


def unpack(words: np.ndarray, width: int) -> np.ndarray:
    """Inverse of ``pack``."""
    lanes = np.ascontiguousarray(words.reshape(-1, width).T)
    out = np.zeros((32, lanes.shape[1]), np.uint32)
    mask = np.uint32((1 << width) - 1)
    for i in range(32):
        word, shift = divmod(i * width, 32)
        out[i] = lanes[word] >> np.uint32(shift)
        if shift + width > 32:
            out[i] |= lanes[word + 1] << np.uint32(32 - shift)
    out &= mask
    return np.ascontiguousarray(out.T).reshape(-1, BLOCK)


def encode_blocks(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(block starts, words of the blocks)."""
    parts = [_encode(ids[at : at + STEP * BLOCK]) for at in range(0, len(ids), STEP * BLOCK)] or [_encode(ids)]
    before = np.concatenate([[0], np.cumsum([len(words) for _, words in parts])])
    starts = np.concatenate([part + np.uint32(at) for (part, _), at in zip(parts, before)])
    return starts, np.concatenate([words for _, words in parts])


def _encode(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    count = -(-len(ids) // BLOCK)
    if not count:
        return np.zeros(0, np.uint32), np.zeros(0, np.uint32)
    padded = np.concatenate([ids, np.full(count * BLOCK - len(ids), ids[-1], ids.dtype)]).astype(np.uint32).reshape(count, BLOCK)
    least = padded.min(axis=1)
    delta = padded - least[:, None]
    length = bit_lengths(delta)
    width = np.sort(length, axis=1)[:, int(np.ceil(PERCENTILE * BLOCK)) - 1]
    wild = length > width[:, None]
    exceptions = wild.sum(axis=1)
    sizes = 2 + 4 * width + exceptions + -(-exceptions // 4)
    starts = np.concatenate([[0], sizes.cumsum()])
    held = np.full(count, BLOCK)
    held[-1] = len(ids) - BLOCK * (count - 1)
    out = np.zeros(starts[-1], np.uint32)
    starts = starts[:-1]
    out[starts] = least
    out[starts + 1] = width | exceptions << 8 | held << 16
    tame = np.where(wild, 0, delta)
    for w in np.unique(width):
        rows = np.flatnonzero(width == w)
        if w:
            out[(starts[rows] + 2)[:, None] + np.arange(4 * w)] = pack(tame[rows], int(w))
    row, position = np.nonzero(wild)
    order = np.arange(len(row)) - np.repeat(exceptions.cumsum() - exceptions, exceptions)
    base = starts[row] + 2 + 4 * width[row]
    out[base + order] = delta[row, position]
    out.view(np.uint8)[4 * (base + exceptions[row]) + order] = position
    return starts.astype(np.uint32), out


def decode_blocks(starts: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Inverse of ``encode_blocks``; ``words`` may go on behind the blocks."""
    parts = [_decode(starts[at : at + STEP], words) for at in range(0, len(starts), STEP)]
    return np.concatenate(parts) if parts else np.zeros(0, np.uint32)


def _decode(starts: np.ndarray, words: np.ndarray) -> np.ndarray:
    starts = starts.astype(np.int64)
    head = words[starts + 1].astype(np.int64)
    width, exceptions, held = head & 255, head >> 8 & 255, head >> 16
    out = np.zeros((len(starts), BLOCK), np.uint32)
    for w in np.unique(width):
        rows = np.flatnonzero(width == w)
        if w:
            out[rows] = unpack(words[(starts[rows] + 2)[:, None] + np.arange(4 * w)], int(w))
    row = np.repeat(np.arange(len(starts)), exceptions)
    order = np.arange(len(row)) - np.repeat(exceptions.cumsum() - exceptions, exceptions)
    base = starts[row] + 2 + 4 * width[row]
    position = words.view(np.uint8)[4 * (base + exceptions[row]) + order]
    out[row, position] = words[base + order]
    out += words[starts][:, None]
    return out.ravel()[np.arange(BLOCK)[None, :].repeat(len(starts), 0).ravel() < held.repeat(BLOCK)]


def encode_file(part: int, number: int, table: pa.RecordBatch, ids: np.ndarray) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_batch(table)
    names = sink.getvalue().to_pybytes()
    names += b"\0" * (-len(names) % 4)
    starts, words = encode_blocks(ids)
    head = np.array([MAGIC, VERSION, part, number, table.num_rows, len(ids) & 0xFFFFFFFF, len(ids) >> 32, len(starts), len(names)], "<u4")
    return head.tobytes() + names + starts.astype("<u4").tobytes() + words.astype("<u4").tobytes()


def decode_file(content: bytes) -> tuple[int, int, pa.RecordBatch, np.ndarray]:
    """(partition, number, document table, ids); what follows the blocks is not read."""
    head = np.frombuffer(content, "<u4", 9)
    if head[0] != MAGIC or head[1] != VERSION:
        raise ValueError("not a file of token blocks")
    at = 36 + int(head[8])
    with pa.ipc.open_stream(content[36:at]) as reader:
        table = reader.read_all().combine_chunks().to_batches()
    starts = np.frombuffer(content, "<u4", int(head[7]), at)
    at += 4 * len(starts)
    words = np.frombuffer(content, "<u4", (len(content) - at) // 4, at)
    ids = decode_blocks(starts, words)
    if len(ids) != int(head[5]) + (int(head[6]) << 32):
        raise ValueError("a file of token blocks is damaged")
    return int(head[2]), int(head[3]), table[0], ids


def cut_bytes(values: pa.Array, bounds: np.ndarray | None = None) -> list[bytes]:
    """The values of an array of large_binary; with bounds, those between each two of them joined."""
    _, offsets, data = values.buffers()
    ends = np.frombuffer(offsets, np.int64)[: len(values) + 1] if offsets else np.zeros(1, np.int64)
    ends = (ends if bounds is None else ends[bounds]).tolist()
    raw = data.to_pybytes() if data else b""
    return list(map(raw.__getitem__, map(slice, ends, ends[1:])))


def lowered(text: str) -> bytes:
    """A text in lower case if the tokenizer, which composes letters before it lowers them, finds the same in it."""
    lower = text.lower()
    # Python lowers a final capital sigma by its place in the word, the tokenizer does not. Marks may
    # go with a small letter but not with its capital, or in another order.
    return (lower if text.isascii() or "Σ" not in text and unicodedata.is_normalized("NFC", lower) else text).encode()


def kinds_of_bytes() -> np.ndarray:
    kinds = np.full(256, OTHER, np.uint8)
    for kind, some in ((SPACE, b" \t\n\v\f\r"), (LETTER, string.ascii_lowercase.encode()), (MARK, string.punctuation.replace("'", "").encode())):
        kinds[list(some)] = kind
    return kinds


#: Kinds of bytes: white space, lower-case letters of ASCII, its punctuation but the apostrophe, all others.
SPACE, LETTER, MARK, OTHER = range(4)
KINDS = kinds_of_bytes()
#: What follows 0xC3 in the UTF-8 of the letters from ß to ÿ.
LATIN = np.isin(np.arange(256), [*range(0x9F, 0xB7), *range(0xB8, 0xC0)])


def cut_words(texts: list[bytes], marks: bool = True) -> tuple[pa.Array, np.ndarray]:
    """(words of all texts, where those of each text begin and end); words are cut at ASCII white space.

    With ``marks``, a word of letters and then punctuation is cut between the two: a tokenizer of the
    steps ``PLAIN`` always cuts there.
    """
    raw = np.frombuffer(b"\n".join([b"", *texts, b""]), np.uint8)
    kinds = KINDS[raw]
    lead = np.flatnonzero(raw[:-1] == 0xC3)
    lead = lead[LATIN[raw[lead + 1]]]
    kinds[lead] = kinds[lead + 1] = LETTER
    # Runs of one kind; white space is before the first and is the last.
    begins = np.flatnonzero(kinds[1:] != kinds[:-1]) + 1
    kind = kinds[begins]
    spaces = np.where(kind == SPACE, np.diff(begins, append=len(raw)), 0)
    # Where a run begins once white space is gone.
    packed = begins - (np.cumsum(spaces) - spaces) - (begins[0] if len(begins) else 0)
    first = (kind != SPACE) & np.concatenate([[True], kind[:-1] == SPACE])[: len(kind)]
    word = first.copy()
    if marks:
        word[1:-1] |= first[:-2] & (kind[:-2] == LETTER) & (kind[1:-1] == MARK) & (kind[2:] == SPACE)
    data = raw[kinds != SPACE]
    offsets = np.append(packed[word], len(data)).astype(np.int64)
    words = pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    ends = np.cumsum([1, *(len(text) + 1 for text in texts)])
    return words, np.searchsorted(begins[word], ends)


class Encoder:
    """Ids of texts by a tokenizer file; words met before are looked up.

    The tokenizer drops white space and never joins across it, so a text's ids are those of its words
    one after the other. Many texts are cut into words at once, Arrow numbers the distinct ones and
    lines up what is found for them; only these are looked up one by one.
    If the file is known to take plain words as they are, they are told apart from the punctuation
    behind them where texts are cut, and go to its model without the steps before it.
    Plain words are encoded many at a time and told apart by the ends of words.
    Known words are kept in two generations: one that is met again moves to the younger one, the
    others are forgotten when the younger one is full.
    """

    limit = 200_000
    # The letters are a-z and, as UTF-8, those from ß to ÿ.
    _plain = re.compile(rb"(?:[a-z]++|\xc3[\x9f-\xb6\xb8-\xbf])++")

    def __init__(self, path: str):
        # Spark runs a task per core; threads of the tokenizer would only get in its way.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = self.plain = Tokenizer.from_file(path)
        steps = json.loads(self.tokenizer.to_str())
        if {name: steps[name] for name in PLAIN} == PLAIN:
            self.plain = Tokenizer(self.tokenizer.model)
            level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
            self.plain.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), level])
        ends = [i for token, i in self.tokenizer.get_vocab().items() if token.endswith("</w>")]
        self.ends = np.zeros(max(self.tokenizer.get_vocab_size(), max(ends, default=0) + 1), bool)
        self.ends[ends] = True
        self.known: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def learn(self, words: list[bytes]) -> None:
        """Make words known; those of the older generation move to the younger."""
        if self.old:
            found = list(map(self.old.get, words))
            self.known.update((word, ids) for word, ids in zip(words, found) if ids is not None)
            words = [word for word, ids in zip(words, found) if ids is None]
        is_plain = self._plain.fullmatch
        plain = [word for word in words if is_plain(word)]
        if len(plain) < len(words):
            self.encode([word for word in words if not is_plain(word)])
        for begin in range(0, len(plain), 500):
            some = plain[begin : begin + 500]
            ids = np.array(self.plain.encode_batch_fast([b" ".join(some).decode()], add_special_tokens=False)[0].ids, "<u4")
            ends = ((np.flatnonzero(self.ends[ids]) + 1) * 4).tolist()
            if len(ends) == len(some):
                raw = ids.tobytes()
                self.known.update(zip(some, map(raw.__getitem__, map(slice, [0, *ends], ends))))
            else:
                self.encode(some)

    def encode(self, texts: list[bytes]) -> None:
        """Look up by the tokenizer, each text on its own."""
        found = self.tokenizer.encode_batch_fast([text.decode() for text in texts], add_special_tokens=False)
        self.known.update((text, np.array(x.ids, "<u4").tobytes()) for text, x in zip(texts, found))

    def ids(self, texts: list[str | None]) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        words, bounds = cut_words([lowered(text or "") for text in texts], self.plain is not self.tokenizer)
        words = words.dictionary_encode()
        distinct = cut_bytes(words.dictionary)
        if len(self.known) > self.limit:
            self.known, self.old = {}, self.known
        found = list(map(self.known.get, distinct))
        missed = [i for i, ids in enumerate(found) if ids is None]
        if missed:
            some = [distinct[i] for i in missed]
            self.learn(some)
            for i, ids in zip(missed, map(self.known.__getitem__, some)):
                found[i] = ids
        return cut_bytes(pa.array(found, pa.large_binary()).take(words.indices), bounds)

    def each(self, texts: pa.Array | list[str | None]) -> Iterator[bytes]:
        """Ids of each text, some texts at a time; a group ends at ``GROUP`` bytes. Only its texts become strings."""
        column = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes, dtype=np.int64) // GROUP
        for some in np.split(np.arange(len(column)), np.flatnonzero(np.diff(ends)) + 1):
            if len(some):
                yield from self.ids(column.slice(some[0], len(some)).to_pylist())


def process_encoder(path: str) -> Encoder:
    """The encoder of this Python process for a tokenizer file, kept from task to task.

    The code of a task is new to the process each time, so the encoder is held by the tokenizer's module.
    """
    import tokenizers

    held = vars(tokenizers).setdefault("tillstream_encoders", {})
    if path not in held:
        held[path] = Encoder(path)
    return held[path]


def tokenizer_path(name: str) -> str:
    """A path as it is; a bare name is a file of the public tokenizers installed on each machine."""
    if "/" in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


def write_token_files(
    docs: DataFrame,
    path: str,
    tokenizer: str = "word_bpe_49k.json",
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = END_ID,
    file_ids: int = FILE_IDS,
) -> None:
    """Write the ids of all documents, in ascending order of id, as files below ``path``.

    Rows without an id come first, rows of one id in the order of their texts. Null and empty texts
    are the end id alone. Spark commits the files, so a lost task leaves none behind.
    """

    def encode(batches):
        from pyspark import TaskContext

        encoder, part, number = process_encoder(tokenizer_path(tokenizer)), TaskContext.get().partitionId(), 0
        end = np.array([end_id], "<u4").tobytes()
        names, sizes, pieces, held = [], [], [], 0
        kind = None
        give_back()

        def file():
            table = pa.record_batch([pa.array(names, kind), pa.array(sizes, pa.int64())], names=["id", "n"])
            ids = np.frombuffer(b"".join(pieces), "<u4")
            return pa.record_batch([pa.array([encode_file(part, number, table, ids)], pa.binary())], names=["content"])

        for batch in batches:
            kind = batch.column(0).type
            for name, piece in zip(batch.column(0).to_pylist(), encoder.each(batch.column(1))):
                names.append(name)
                sizes.append(len(piece) // 4 + 1)
                pieces += (piece, end)
                held += sizes[-1]
                if held >= file_ids:
                    yield file()
                    names, sizes, pieces, held, number = [], [], [], 0, number + 1
        if names:
            yield file()
        give_back()

    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("body"))
    ordered = slim.repartitionByRange(F.col("id").asc_nulls_first(), F.xxhash64("body")).sortWithinPartitions(
        F.col("id").asc_nulls_first(), F.xxhash64("body"), "body"
    )
    # The text writer puts the bytes of a value and one separator into a file of its own.
    content = ordered.mapInArrow(encode, "content binary").select(F.col("content").cast("string").alias("value"))
    with small_batches(docs.sparkSession):
        content.write.option("maxRecordsPerFile", 1).option("compression", "none").text(path)


def read_token_files(spark: SparkSession, path: str, id_type: str = "bigint", with_ids: bool = False) -> DataFrame:
    """(part, number, place, id, n_tokens, ids_crc32 and, if asked for, ids) per document of the files."""
    extra = ", ids array<long>" if with_ids else ""

    def decode(batches):
        for batch in batches:
            for content in batch.column(0).to_pylist():
                part, number, table, ids = decode_file(content)
                sizes = table.column(1).to_numpy()
                ends = sizes.cumsum()
                crcs = [zlib.crc32(ids[b - n : b].tobytes()) for b, n in zip(ends, sizes)]
                count = len(sizes)
                columns = {
                    "part": pa.array([part] * count, pa.int64()), "number": pa.array([number] * count, pa.int64()),
                    "place": pa.array(ends - sizes), "id": table.column(0), "n_tokens": pa.array(sizes), "ids_crc32": pa.array(crcs, pa.int64()),
                }
                if with_ids:
                    columns["ids"] = lists([ids[b - n : b].astype(np.int64) for b, n in zip(ends, sizes)], pa.int64())
                yield pa.record_batch(list(columns.values()), names=list(columns))

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    return files.mapInArrow(decode, f"part long, number long, place long, id {id_type}, n_tokens long, ids_crc32 long{extra}")


def token_output(
    docs: DataFrame, tokenizer: str = "word_bpe_49k.json", id_col: str = "doc_id", text_col: str = "text", path: str | None = None
) -> DataFrame:
    """(id, start, n_tokens, ids_crc32) per document, as read back from the files written.

    ``start`` is the number of ids of all documents before it. Without ``path`` the files go to a
    folder of their own in the shared one. An empty table gives no rows.
    """
    spark = docs.sparkSession
    path = path or f"{shared_folder(spark).rstrip('/')}/llm-tokens-{uuid.uuid4().hex}"
    write_token_files(docs, path, tokenizer, id_col, text_col)
    kind = docs.schema[id_col].dataType.simpleString()
    rows = stored(read_token_files(spark, path, kind), "token-rows")
    files = rows.groupBy("part", "number").agg(F.sum("n_tokens").alias("ids"))
    before = F.sum("ids").over(Window.partitionBy("part").orderBy("number")) - F.col("ids")
    files = files.withColumn("in_part", before)
    # One row per range partition: their number is a setting, not a size of the data.
    parts = rows.groupBy("part").agg(F.sum("n_tokens").alias("ids")).orderBy("part").collect()
    offsets, total = [], 0
    for row in parts:
        offsets.append((row["part"], total))
        total += row["ids"]
    bases = F.broadcast(driver_table(spark, offsets, "part long, base long"))
    joined = rows.join(files.select("part", "number", "in_part"), ["part", "number"]).join(bases, "part")
    start = (F.col("base") + F.col("in_part") + F.col("place")).alias("start")
    return joined.select(F.col("id").alias(id_col), start, "n_tokens", "ids_crc32")
