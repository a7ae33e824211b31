"""Token-id files: one zstandard frame per document, under one shared dictionary.

Short id arrays compress badly alone, so a dictionary trained on serialized
arrays is shared by all frames; every file's head names it by hash. Files hold
documents in ascending id order, a range of ids each, and an index table has
each frame's file, offset and length, so a single short document can be read
without its neighbours. As with any table, the index only names files of tasks
that ended well.
"""

import hashlib
import json
import os
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain, compress
from string import punctuation

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from tokenizers import Tokenizer

from ratelab.llm.files import byte_ranges, spread_by_stretch
from ratelab.llm.tasks import map_batches

MAGIC = b"TOKZ0001"
#: Magic and the dictionary's SHA-256.
HEAD_BYTES = len(MAGIC) + 32
CACHE_CHUNKS = 1_000_000
#: Longer texts go to the tokenizer in parts.
PART_CHARS = 1 << 18
#: How byte-level tokenizers of this kind cut text into words; a fixed value.
WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
#: Texts of other characters, or with white space other than single blanks and
#: line feeds, are encoded whole: Unicode versions may differ about them.
_PLAIN = re.compile("[\n !-~\xa1-\xac\xae-ɏ]*")
#: All letters of such texts.
_ALPHA = "".join(c for c in map(chr, range(0x250)) if _PLAIN.fullmatch(c) and c.isalpha())
#: A place where words never meet across: a blank between two letters or digits.
_CUT = re.compile(r"(?<=[A-Za-z0-9]) (?=[A-Za-z0-9])")
_FEEDS = re.compile(r"(\n+)")
#: Before the first piece of a line, and after line feeds at the end of a text; no plain text has them.
FIRST, LAST = "\x01", "\x02"
#: Texts of about so many characters are encoded together.
TOGETHER_CHARS = 1 << 22


def _marked(text: str) -> str:
    """A plain text with blanks between all its pieces; line feeds in a row are one of them."""
    if "\n\n" not in text and text[-1:] != "\n":
        return FIRST + text.replace("\n", f" \n {FIRST}")
    text = FIRST + _FEEDS.sub(rf" \1 {FIRST}", text)
    return text[: -len(FIRST) - 1] + LAST if text.endswith(f"\n {FIRST}") else text


def _byte_letters() -> np.ndarray:
    """How byte-level tokenizers of this kind write a byte: the number of one printable character."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in printable]
    letters = {b: b for b in printable} | {b: 256 + i for i, b in enumerate(others)}
    return np.array([letters[b] for b in range(256)], dtype="<u2")


_BYTE_LETTERS = _byte_letters()
#: Bytes that no UTF-8 text has.
_NO_TEXT = (0xC0, 0xC1, *range(0xF5, 0x100))
#: So many words go to the model together.
MODEL_WORDS = 256


@dataclass(frozen=True)
class _Ids:
    """Ids of many strings: the string at i has ``lengths[i]`` of ``numbers`` from ``starts[i]`` on."""

    numbers: np.ndarray
    starts: np.ndarray
    lengths: np.ndarray

    @classmethod
    def ended(cls, numbers: np.ndarray, end: int) -> "_Ids":
        """Each string's ids are followed by ``end``, which is no id of theirs."""
        ends = np.flatnonzero(numbers == end)
        starts = np.append(0, ends[:-1] + 1)[: len(ends)]
        return cls(numbers, starts, ends - starts)

    @classmethod
    def of_bytes(cls, found: list[bytes]) -> "_Ids":
        lengths = np.fromiter(map(len, found), np.int64, len(found)) // 4
        return cls(np.frombuffer(b"".join(found), dtype="<u4"), np.cumsum(lengths) - lengths, lengths)

    @classmethod
    def one_after_another(cls, parts: "list[_Ids]") -> "_Ids":
        shifts = np.cumsum([0, *(len(p.numbers) for p in parts)])
        starts = np.concatenate([p.starts + shift for p, shift in zip(parts, shifts)])
        return cls(np.concatenate([p.numbers for p in parts]), starts, np.concatenate([p.lengths for p in parts]))

    def at(self, places: np.ndarray) -> "_Ids":
        return _Ids(self.numbers, self.starts[places], self.lengths[places])

    def joined(self) -> np.ndarray:
        """The ids of all strings in order."""
        ends = np.cumsum(self.lengths)
        places = np.repeat(self.starts - ends + self.lengths, self.lengths)
        places += np.arange(len(places))
        return self.numbers[places]

    def to_bytes(self) -> list[bytes]:
        data = self.numbers.tobytes()
        starts = 4 * self.starts
        ends = starts + 4 * self.lengths
        return [data[lo:hi] for lo, hi in zip(starts.tolist(), ends.tolist())]


INDEX_SCHEMA = (
    "{id} {kind}, part int, file string, offset bigint, length bigint, before bigint, n_tokens bigint"
)


@dataclass(frozen=True)
class TokenFileRule:
    """The dictionary has ``dictionary_bytes`` at most and is trained on at most ``sample_documents``
    texts of at most ``sample_chars`` characters, chosen by a hash of the id. ``end_id`` ends each
    document; None adds nothing."""

    end_id: int | None = 2
    dictionary_bytes: int = 65_536
    sample_documents: int = 1_000
    sample_chars: int = 20_000
    level: int = 3
    gap_bytes: int = 1 << 14
    range_bytes: int = 1 << 22


class Encoder:
    """The tokenizers library over texts, with the ids of words remembered.

    The tokenizer's words depend on nothing around them, so plain texts are cut at
    line feeds and blanks. The different words of a batch are found by Arrow, and
    those that aren't known yet are encoded together, many in each call.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        level = spec["pre_tokenizer"]
        if spec["normalizer"] or level["type"] != "ByteLevel" or level["add_prefix_space"] or not level["use_regex"]:
            raise ValueError(f"{path}: another way of cutting text into words")
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.added = [t["content"] for t in spec["added_tokens"]]
        #: Ids of words after a blank, and of words without one before them.
        self.known: dict[str, bytes] = {}
        self.firsts: dict[str, bytes] = {}
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        self.line_feed = vocab["Ċ"]
        #: The library with its model alone: it takes words that are cut and written in byte letters already.
        self.model = Tokenizer(self.library.model)
        # The model joins nothing over a letter without a merge, so that words between such letters get
        # the ids they get alone.
        merged = set(chain.from_iterable(map("".join, merges)))
        apart = [b for b in _NO_TEXT if (c := chr(_BYTE_LETTERS[b])) in vocab and c not in merged]
        odd = ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")
        self.in_pieces = bool(apart) and not any(spec["model"].get(k) for k in odd)
        if self.in_pieces:
            self.apart = vocab[chr(_BYTE_LETTERS[apart[0]])]
            self.letters = _BYTE_LETTERS.copy()
            self.letters[ord("\n")] = _BYTE_LETTERS[apart[0]]
        self.marks: dict[str, bytes] = {}

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """Ids of whole texts as little-endian unsigned 32-bit integers."""
        plain = [self.in_pieces and self._is_plain(t) for t in texts]
        ids = iter(self._by_pieces(list(map(_marked, compress(texts, plain)))))
        return [next(ids) if p else self._whole(text) for text, p in zip(texts, plain)]

    def _by_pieces(self, texts: list[str]) -> list[bytes]:
        """Ids of marked texts: each different word is looked up once, its ids are copied to all its places."""
        split = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
        coded = split.flatten().dictionary_encode()
        pieces, of = coded.dictionary, coded.indices.to_numpy()
        is_feeds = pc.starts_with(pieces, "\n").to_numpy(zero_copy_only=False)
        is_first = pc.starts_with(pieces, FIRST).to_numpy(zero_copy_only=False)
        kinds = [np.flatnonzero(kind) for kind in (~is_feeds & ~is_first, is_first, is_feeds)]
        after, first, feeds = (pieces.take(pa.array(kind)) for kind in kinds)
        cores, marks, marked = _stems(after)
        first_cores, first_marks, first_marked = _stems(pc.utf8_slice_codeunits(first, 1))
        bare = pa.concat_arrays([first_cores, marks, first_marks])
        known, known_of = self._words(" ", cores, self.known, CACHE_CHUNKS)
        firsts, firsts_of = self._words("", bare, self.firsts, CACHE_CHUNKS // 10)
        ends = [(len(p.rstrip(LAST)), p[-1] == LAST) for p in feeds.to_pylist()]
        words = _Ids.one_after_another([known, firsts, _Ids.of_bytes([self._feeds(*end) for end in ends] + [b""])])
        # A piece has one or two words; the last word of all has no ids.
        pairs = np.full((len(pieces), 2), len(words.starts) - 1)
        firsts_of = firsts_of + len(known.starts)
        pairs[kinds[0], 0] = known_of
        pairs[kinds[1], 0], pairs[kinds[0][marked], 1], pairs[kinds[1][first_marked], 1] = np.split(
            firsts_of, [len(first), len(first) + len(marks)]
        )
        pairs[kinds[2], 0] = len(known.starts) + len(firsts.starts) + np.arange(len(feeds))
        lengths = words.lengths[pairs].sum(axis=1)
        found = _Ids(words.at(pairs.ravel()).joined(), np.cumsum(lengths) - lengths, lengths).at(of)
        data = found.joined().tobytes()
        cuts = (4 * np.append(0, np.cumsum(found.lengths))[split.offsets.to_numpy()]).tolist()
        return [data[lo:hi] for lo, hi in zip(cuts, cuts[1:])]

    def _words(self, blank: str, words: pa.Array, known: dict[str, bytes], most: int) -> tuple[_Ids, np.ndarray]:
        """Ids of the different ones of some words, all after ``blank``, and which of them each word is.
        The words are remembered from now on."""
        coded = words.dictionary_encode()
        different, of = coded.dictionary, coded.indices.to_numpy()
        names = different.to_pylist()
        ids = list(map(known.get, names))
        is_new = np.array([i is None for i in ids], bool)
        learned = self._learn(blank, different.filter(pa.array(is_new)))
        place = np.where(is_new, np.cumsum(is_new), len(learned.starts) + np.cumsum(~is_new)) - 1
        more = dict(zip(compress(names, is_new), learned.to_bytes()))
        found = _Ids.one_after_another([learned, _Ids.of_bytes(list(compress(ids, ~is_new)))]).at(place)
        if len(known) + len(more) > most:
            known.clear()
        known.update(more)
        return found, of

    def _learn(self, blank: str, words: pa.Array) -> _Ids:
        """Ids of words after ``blank``, none with line feeds: those of letters or marks alone by the library's
        model, all others by one call of the library."""
        # Letters alone, or marks, are one word, with the blank before them: there is nothing to cut.
        one = pc.or_(pc.utf8_is_alpha(words), pc.equal(pc.utf8_ltrim(words, punctuation), ""))
        one = one.to_numpy(zero_copy_only=False)
        model = self._by_model(blank, words.filter(pa.array(one)))
        rest = words.filter(pa.array(~one)).to_pylist()
        library = _Ids.of_bytes([])
        if rest:
            # Between line feeds every word is cut as in its text.
            text = blank + f"\n{blank}".join(rest)
            ids = self.library.encode_batch_fast([text], add_special_tokens=False)[0].ids
            library = _Ids.ended(np.array([*ids, self.line_feed], "<u4"), self.line_feed)
        if (len(model.starts), len(library.starts)) != (np.count_nonzero(one), len(rest)):
            raise ValueError("words and their ids don't match")
        places = np.where(one, np.cumsum(one), len(model.starts) + np.cumsum(~one)) - 1
        return _Ids.one_after_another([model, library]).at(places)

    def _by_model(self, blank: str, words: pa.Array) -> _Ids:
        """Ids of words that are cut already, ``MODEL_WORDS`` of them at a time."""
        if not len(words):
            return _Ids.of_bytes([])
        before, after, between = (pa.scalar(x, pa.large_string()) for x in (blank, "\n", ""))
        _, offsets, data = pc.binary_join_element_wise(before, words, after, between).buffers()
        at = np.frombuffer(offsets, np.int64)[: len(words) + 1]
        # A byte is a letter, so places in the bytes are those in the letters.
        written = self.letters[np.frombuffer(data, np.uint8)[: at[-1]]].tobytes().decode("utf-16-le")
        cuts = [*at[:-1:MODEL_WORDS].tolist(), len(written)]
        parts = [written[lo:hi] for lo, hi in zip(cuts, cuts[1:])]
        coded = self.model.encode_batch_fast(parts, add_special_tokens=False)
        return _Ids.ended(np.fromiter(chain.from_iterable(e.ids for e in coded), "<u4"), self.apart)

    def _is_plain(self, text: str) -> bool:
        """Whether single blanks and line feeds are all the white space, and no blank touches another or an end."""
        return (
            _PLAIN.fullmatch(text) is not None
            and not ("  " in text or " \n" in text or "\n " in text or text[:1] == " " or text[-1:] == " ")
            and not any(mark in text for mark in self.added)
        )

    def _feeds(self, n: int, at_end: bool) -> bytes:
        """Ids of line feeds in a row: one word at the end of a text, else the last one is a word of its own."""
        if n == 1:
            return self._mark("\n")
        return self._mark("\n" * n) if at_end else self._mark("\n" * (n - 1)) + self._mark("\n")

    def _mark(self, mark: str) -> bytes:
        """Ids of line feeds that are one word; those of up to 64 are remembered."""
        ids = self.marks.get(mark)
        if ids is None:
            ids = np.array(self.library.encode(mark, add_special_tokens=False).ids, dtype="<u4").tobytes()
            if len(mark) <= 64 and len(self.marks) < CACHE_CHUNKS // 10:
                self.marks[mark] = ids
        return ids

    def _whole(self, text: str) -> bytes:
        """Directly, in parts where the text is long and has a place to cut it."""
        parts, start = [], 0
        while len(text) - start > PART_CHARS:
            cut = _CUT.search(text, start + PART_CHARS)
            if cut is None:
                break
            parts.append(text[start : cut.start()])
            start = cut.start()
        parts.append(text[start:])
        ids = (self.library.encode(p, add_special_tokens=False).ids for p in parts)
        return b"".join(np.array(i, dtype="<u4").tobytes() for i in ids)


def _stems(pieces: pa.Array) -> tuple[pa.Array, pa.Array, np.ndarray]:
    """The pieces without marks after letters, these marks, and which pieces have some."""
    # Marks after letters alone, up to the end of the piece, are a word of their own.
    stems = pc.utf8_rtrim(pieces, punctuation)
    stemmed = pc.and_(pc.utf8_is_alpha(stems), pc.not_equal(stems, pieces))
    marks = pc.utf8_ltrim(pieces.filter(stemmed), _ALPHA)
    return pc.if_else(stemmed, stems, pieces), marks, np.flatnonzero(stemmed.to_numpy(zero_copy_only=False))


def _stretches(texts: list[str]) -> Iterator[list[str]]:
    """The texts in order, about ``TOGETHER_CHARS`` characters at a time."""
    start, size = 0, 0
    for end, text in enumerate(texts, start=1):
        size += len(text)
        if size >= TOGETHER_CHARS or end == len(texts):
            yield texts[start:end]
            start, size = end, 0


@lru_cache(maxsize=2)
def load(path: str) -> Encoder:
    """Once per Python worker."""
    # A task has one core; the library would take all.
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    return Encoder(path)


def train_dictionary(docs: DataFrame, path: str, id_col: str, text_col: str, rule: TokenFileRule) -> bytes:
    """A dictionary from a bounded sample. Where too little is there to train on, the serialized
    sample itself; without any, nothing."""
    texts = docs.select(
        F.xxhash64(F.col(id_col).cast("string")).alias("draw"), F.xxhash64(text_col).alias("tie"), F.col(text_col).alias("text")
    )
    texts = texts.where(F.length("text").between(1, rule.sample_chars))
    # Only two numbers a row are sorted; the few texts they name are fetched where they are.
    keys = texts.select("draw", "tie").distinct().orderBy("draw", "tie").limit(rule.sample_documents)
    sample = texts.join(F.broadcast(keys), ["draw", "tie"]).dropDuplicates(["draw", "tie"])

    def serialize(batches):
        for batch in batches:
            found = load(path).encode_batch(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(found, pa.binary())], names=["draw", "tie", "ids"])

    rows = map_batches(sample, serialize, "draw bigint, tie bigint, ids binary").collect()
    samples = [bytes(r["ids"]) for r in sorted(rows, key=lambda r: (r["draw"], r["tie"]))]
    size = min(rule.dictionary_bytes, sum(map(len, samples)) // 8)
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(samples)[: rule.dictionary_bytes]


def _dictionary(data: bytes):
    if len(data) < 8:
        return None
    trained = data[:4] == zstandard.DICT_TYPE_FULLDICT.to_bytes(4, "little") or data[:4] == b"\x37\xa4\x30\xec"
    kind = zstandard.DICT_TYPE_FULLDICT if trained else zstandard.DICT_TYPE_RAWCONTENT
    return zstandard.ZstdCompressionDict(data, dict_type=kind)


def write_tokens(
    docs: DataFrame,
    folder: str,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    rule: TokenFileRule = TokenFileRule(),
) -> DataFrame:
    """Writes ``dictionary``, token files and ``index.parquet`` below ``folder`` and returns the index:
    ``id, part, file, offset, length, before, n_tokens``.

    Files follow ascending ids, nulls first: ``part`` numbers them, ``before``
    counts the ids before a document in its file. Rows that repeat an id follow
    one another, in an order by a hash of their texts. A null text counts as
    empty and has only the end id. Texts are moved once, to be sorted. An empty
    table gives no file but the dictionary, and an empty index. Other columns,
    whatever their names, are not looked at. A very long text is encoded in
    parts where it can be cut, and is one frame.
    """
    data = train_dictionary(docs, path, id_col, text_col, rule)
    system, base = fs.FileSystem.from_uri(folder)
    system.create_dir(base, recursive=True)
    with system.open_output_stream(f"{base}/dictionary", compression=None) as out:
        out.write(data)
    end = b"" if rule.end_id is None else rule.end_id.to_bytes(4, "little")
    named = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = named.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = fs.FileSystem.from_uri(folder)
        part, file = TaskContext.get().partitionId(), f"{uuid.uuid4().hex}.tok"
        shared = _dictionary(data)
        if shared is not None:
            shared.precompute_compress(level=rule.level)  # else every frame digests it anew
        packer = zstandard.ZstdCompressor(level=rule.level, dict_data=shared)
        out, offset, before = None, HEAD_BYTES, 0
        for batch in batches:
            if out is None:
                out = system.open_output_stream(f"{base}/{file}", compression=None)
                out.write(MAGIC + hashlib.sha256(data).digest())
            texts = [t or "" for t in batch.column("text").to_pylist()]
            offsets, lengths, befores, counts = [], [], [], []
            for stretch in _stretches(texts):
                for ids in load(path).encode_batch(stretch):
                    frame = packer.compress(ids + end)
                    out.write(frame)
                    offsets.append(offset)
                    lengths.append(len(frame))
                    befores.append(before)
                    counts.append((len(ids) + len(end)) // 4)
                    offset += len(frame)
                    before += counts[-1]
            n = len(texts)
            columns = [pa.array([part] * n, pa.int32()), pa.array([file] * n)]
            columns += [pa.array(c, pa.int64()) for c in (offsets, lengths, befores, counts)]
            names = ["id", "part", "file", "offset", "length", "before", "n_tokens"]
            yield pa.RecordBatch.from_arrays([batch.column("id"), *columns], names=names)
        if out is not None:
            out.close()

    schema = INDEX_SCHEMA.format(id="id", kind=kind)
    first = F.col("id").asc_nulls_first()
    placed = named.repartitionByRange(first).sortWithinPartitions(first, F.xxhash64("text"))
    map_batches(placed, run, schema).write.parquet(f"{folder}/index.parquet")
    return docs.sparkSession.read.schema(schema).parquet(f"{folder}/index.parquet")


def with_starts(index: DataFrame) -> DataFrame:
    """Adds ``start``, the ids of all documents before. The window holds one row per file."""
    parts = index.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    upto = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    bases = parts.select("part", F.coalesce(upto, F.lit(0)).alias("base"))
    return index.join(bases, "part").withColumn("start", F.col("base") + F.col("before")).drop("base")


def read_tokens(index: DataFrame, folder: str, rule: TokenFileRule = TokenFileRule()) -> DataFrame:
    """The index rows with ``ids``, a document's ids as little-endian unsigned 32-bit integers.

    Rows are spread by file and stretch of a file and read in coalesced ranges.
    A file under another dictionary than the folder's is refused. An empty
    index gives no rows; columns of the index beyond its own are passed on.
    """

    def run(batches):
        system, base = fs.FileSystem.from_uri(folder)
        with system.open_input_stream(f"{base}/dictionary", compression=None) as source:
            data = source.read()
        unpacker = zstandard.ZstdDecompressor(dict_data=_dictionary(data))
        head = MAGIC + hashlib.sha256(data).digest()
        for batch in batches:
            files, offsets, lengths = (batch.column(c).to_pylist() for c in ("file", "offset", "length"))
            at = 0
            while at < len(files):
                end = at + 1
                while end < len(files) and files[end] == files[at]:
                    end += 1
                with system.open_input_file(f"{base}/{files[at]}") as source:
                    if source.read_at(HEAD_BYTES, 0) != head:
                        raise ValueError(f"{files[at]} was written with another dictionary")
                    for lo, hi in byte_ranges(offsets[at:end], lengths[at:end], rule.gap_bytes, rule.range_bytes):
                        lo, hi = at + lo, at + hi
                        first = offsets[lo]
                        block = memoryview(source.read_at(offsets[hi - 1] + lengths[hi - 1] - first, first))
                        ids = [
                            unpacker.decompress(block[offsets[i] - first : offsets[i] - first + lengths[i]])
                            for i in range(lo, hi)
                        ]
                        rows = batch.slice(lo, hi - lo)
                        yield pa.RecordBatch.from_arrays(
                            [*rows.columns, pa.array(ids, pa.binary())], names=[*rows.schema.names, "ids"]
                        )
                at = end

    spread = spread_by_stretch(index, 4 * rule.range_bytes)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in index.schema)
    return map_batches(spread, run, f"{fields}, ids binary")


def read_document(folder: str, file: str, offset: int, length: int) -> np.ndarray:
    """One document's ids, without a job and without its neighbours."""
    system, base = fs.FileSystem.from_uri(folder)
    with system.open_input_stream(f"{base}/dictionary", compression=None) as source:
        data = source.read()
    with system.open_input_file(f"{base}/{file}") as source:
        if source.read_at(HEAD_BYTES, 0) != MAGIC + hashlib.sha256(data).digest():
            raise ValueError(f"{file} was written with another dictionary")
        frame = source.read_at(length, offset)
    return np.frombuffer(zstandard.ZstdDecompressor(dict_data=_dictionary(data)).decompress(frame), dtype="<u4")
