"""BPE encoding and decoding as streaming transducers.

Encoding. The tokens of a prefix of a word are known as soon as the prefix is:
at every position exactly one token can end the encoding of the prefix, the one
that fits the last token before it, where two tokens fit if no merge would have
crossed the place where they meet. What comes later decides only which of the
last few positions is used, and a chain of merges, each stronger than the one
before, bounds how far back that reaches: the merge list's sufficient
lookahead. Tokens before it are stable and are emitted; the state that is kept
is as long as the lookahead and the longest token, however long the word.

Decoding. Token bytes go through an incremental UTF-8 decoder that keeps at
most the bytes of one unfinished character.
"""

import codecs
import hashlib
import json
import re
import unicodedata
from collections.abc import Iterable, Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratelab.llm.tasks import map_batches

PIECE_CHARS = 1 << 18
CACHE_WORDS = 500_000
CACHE_PAIRS = 1_000_000
#: Symbols that a word gets beyond what must be kept before tokens are looked for.
STEP = 256
#: Words up to this length are remembered.
SHORT = 64
#: White space as the tokenizers library has it; str.split() also takes the separators \x1c to \x1f.
_SPACE = re.compile("[\t-\r \x85\xa0  -     　]")
_SEPARATORS = re.compile("[\x1c-\x1f]")


def byte_characters() -> list[str]:
    """The character that stands for each byte: itself where printable, else the next from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    found = {b: chr(b) for b in plain}
    for i, b in enumerate(b for b in range(256) if b not in found):
        found[b] = chr(256 + i)
    return [found[b] for b in range(256)]


class Merges:
    """A merge list: which tokens fit side by side, and how far ahead that needs to look."""

    def __init__(self, vocab: dict[str, int], merges: Iterable[tuple[str, str]], suffix: str):
        #: Tokens inside a word and at its end, by their symbols; -1 where only longer ones start so.
        self.inner: dict[str, int] = {}
        self.last: dict[str, int] = {}
        lengths: dict[int, int] = {}
        for token, i in vocab.items():
            ends = bool(suffix) and token.endswith(suffix) and token != suffix
            plain = token[: -len(suffix)] if ends else token
            if ends or not suffix:
                self.last[plain] = i
            if not ends:
                self.inner[plain] = i
            lengths[i] = len(plain)
            for n in range(1, len(plain) + 1):
                self.inner.setdefault(plain[:n], -1)
        self.rank: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int, int]] = {}
        for rank, (left, right) in enumerate(merges):
            pair = vocab[left], vocab[right]
            self.rank[pair] = rank
            self.parts[vocab[left + right]] = (rank, *pair)
        self.longest = max(lengths.values(), default=1)
        self.lookahead = self._lookahead(lengths)
        self._fits: dict[int, bool] = {}

    def _lookahead(self, lengths: dict[int, int]) -> int:
        """Symbols after a place that can still decide whether tokens meet there.

        A merge (u, v) is prevented by a stronger one that takes v, or a part at
        v's right end, together with what follows; that one may in turn be
        prevented by a still stronger one further right. Ranks fall along such a
        chain, so one pass in rank order finds the longest.
        """
        reach: dict[int, int] = {}  # of the stronger merges that start with a token
        most = 1
        for (left, right), _ in sorted(self.rank.items(), key=lambda x: x[1]):
            beyond, part = 0, right
            while True:
                beyond = max(beyond, reach.get(part, 0))
                if part not in self.parts:
                    break
                part = self.parts[part][2]
            total = lengths[right] + beyond
            reach[left] = max(reach.get(left, 0), total)
            most = max(most, total)
        return most + 1

    def fits(self, a: int, b: int) -> bool:
        """Whether encoding the text of both gives these two tokens.

        Undoes the later of their merges, again and again; no pair that meets at
        the boundary on the way may merge before the merge just undone.
        """
        known = self._fits.get(a << 32 | b)
        if known is None:
            known = self._meet(a, b)
            if len(self._fits) >= CACHE_PAIRS:
                self._fits.clear()
            self._fits[a << 32 | b] = known
        return known

    def walk(self, held: str, ends: list, start: int, upto: int, before: int, final: bool) -> None:
        """Finds the tokens that start at positions ``start`` to ``upto`` of ``held``.

        ``ends[i]`` is the token that ends the encoding of the first i symbols,
        with its start, or None; ``before`` is the token before position 0.
        """
        inner, last, known_fits, fits = self.inner, self.last, self._fits, self.fits
        n = len(held)
        for j in range(start, upto):
            at = ends[j]
            if at is None:
                continue
            left = at[0] if j else before
            for i in range(j + 1, n + 1):
                token = inner.get(held[j:i])
                if token is None:
                    break
                if i == n and final:
                    token = last.get(held[j:i], -1)
                if token < 0 or ends[i] is not None:
                    continue
                if left >= 0:
                    fit = known_fits.get(left << 32 | token)
                    if not (fits(left, token) if fit is None else fit):
                        continue
                ends[i] = (token, j)

    def _meet(self, a: int, b: int) -> bool:
        none = (-1, -1, -1)
        limit, right_undone = len(self.rank), False
        while True:
            rank = self.rank.get((a, b))
            if rank is not None and (rank < limit or (rank == limit and right_undone)):
                return False
            of_a, of_b = self.parts.get(a, none), self.parts.get(b, none)
            if of_a is none and of_b is none:
                return True
            right_undone = of_b[0] >= of_a[0]
            limit = of_b[0] if right_undone else of_a[0]
            if right_undone:
                b = of_b[1]
            else:
                a = of_a[2]


class WordTransducer:
    """Takes the symbols of one word piece by piece, gives tokens once they are stable."""

    def __init__(self, merges: Merges):
        self.merges = merges
        self.held = ""
        #: For each held position, the token that ends there and where it starts.
        self.ends: list[tuple[int, int] | None] = [(-1, -1)]
        self.done = 0
        self.before = -1

    def feed(self, symbols: str) -> list[int]:
        found: list[int] = []
        keep = self.merges.lookahead + self.merges.longest + STEP
        for at in range(0, len(symbols), STEP):
            self.held += symbols[at : at + STEP]
            self.ends += [None] * (len(self.held) + 1 - len(self.ends))
            if len(self.held) <= keep:
                continue
            # The last symbol may turn out to end the word: it waits, and so do
            # places from which a token might reach it.
            self._walk(len(self.held) - self.merges.longest)
            found += self._emit()
        return found

    def finish(self) -> list[int]:
        """The tokens that are left of the word."""
        self._walk(len(self.held), final=True)
        return self._path(len(self.held), 0)

    def _walk(self, upto: int, final: bool = False) -> None:
        self.merges.walk(self.held, self.ends, self.done, upto, self.before, final)
        self.done = max(self.done, upto)

    def _path(self, at: int, stop: int) -> list[int]:
        tokens = []
        while at > stop:
            token, at = self.ends[at]
            tokens.append(token)
        return tokens[::-1]

    def _emit(self) -> list[int]:
        """Tokens that every way on shares: those before the place where all open paths part."""
        open_ends = [i for i in range(self.done, len(self.ends)) if self.ends[i] is not None]
        shared = None
        for end in open_ends:
            places, at = {end}, end
            while at > 0:
                at = self.ends[at][1]
                places.add(at)
            shared = places if shared is None else shared & places
        cut = max((p for p in shared or () if p <= self.done), default=0)
        if cut == 0:
            return []
        tokens = self._path(cut, 0)
        self.before = tokens[-1]
        self.held = self.held[cut:]
        self.ends = [e and (e[0], e[1] - cut) for e in self.ends[cut:]]
        self.ends[0] = (-1, -1)
        self.done -= cut
        return tokens


class ByteToText:
    """Turns ids into text as they come.

    With a byte-level decoder a token is the bytes its characters stand for;
    without one it is its own characters, and tokens are joined with a space.
    """

    def __init__(self, pieces: dict[int, bytes], separator: bytes = b""):
        self.pieces, self.separator = pieces, separator
        self.started = False
        self.machine = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: Iterable[int]) -> str:
        data = self.separator.join(map(self.pieces.__getitem__, ids))
        if data or ids:
            if self.started:
                data = self.separator + data
            self.started = True
        return self.machine.decode(data)

    def finish(self) -> str:
        return self.machine.decode(b"", final=True)


class Tokenizer:
    """A tokenizer file: its rules for cutting text into words, and its merges.

    Reads files whose normalizer is made of NFC, white space runs to one space
    and lower case, whose words are the matches of a pattern, and whose model is
    byte-level BPE. Anything else is refused.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        steps = [(n["type"], n.get("pattern")) for n in (spec["normalizer"] or {"normalizers": []})["normalizers"]]
        known = [("NFC", None), ("Replace", {"Regex": r"\s+"}), ("Lowercase", None)]
        split, level = spec["pre_tokenizer"]["pretokenizers"]
        if steps != known or (split["behavior"], split["invert"]) != ("Removed", True) or level["use_regex"]:
            raise ValueError(f"{path}: another way of cutting text into words")
        if spec["decoder"] is not None or spec["model"]["unk_token"] is not None:
            raise ValueError(f"{path}: another decoder or unknown tokens")
        self.words = regex.compile(split["pattern"]["Regex"].replace(r"\s", _SPACE.pattern[1:-1]))
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.marks = re.compile("|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) or "(?!)")
        model = spec["model"]
        merges = [tuple(m.split(" ", 1)) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.merges = Merges(model["vocab"], merges, model["end_of_word_suffix"] or "")
        self.alphabet = dict(enumerate(byte_characters()))
        self.pieces = {i: t.encode() for t, i in {**model["vocab"], **self.added}.items()}
        self.cache = _Memo(self.word_ids)
        self.chunks = _Memo(self.chunk_ids)

    def word_ids(self, word: str) -> bytes:
        """The ids of one word, as little-endian unsigned 32-bit integers."""
        symbols = word.encode("utf-8", "surrogatepass").decode("latin-1").translate(self.alphabet)
        transducer = WordTransducer(self.merges)
        return np.array(transducer.feed(symbols) + transducer.finish(), dtype="<u4").tobytes()

    def chunk_ids(self, chunk: str) -> bytes:
        """The ids of the words between two white spaces."""
        return b"".join(map(self.cache.__getitem__, self.words.findall(chunk)))

    def encode(self, text: str) -> Iterator[bytes]:
        """The ids of a whole text, piece by piece, as little-endian unsigned 32-bit integers."""
        start = 0
        for mark in self.marks.finditer(text):
            yield from self._encode_plain(text[start : mark.start()])
            yield self.added[mark.group()].to_bytes(4, "little")
            start = mark.end()
        yield from self._encode_plain(text[start:] if start else text)

    def _encode_plain(self, text: str) -> Iterator[bytes]:
        for piece in _pieces(text):
            # Lower case without regard to context: a final sigma is a sigma.
            piece = unicodedata.normalize("NFC", piece).replace("Σ", "σ").lower()
            chunks = _SPACE.split(piece) if _SEPARATORS.search(piece) else piece.split()
            yield b"".join(map(self.chunks.__getitem__, chunks))

    def decoder(self) -> ByteToText:
        return ByteToText(self.pieces, b" ")


class _Memo(dict):
    """Ids by word, or by chunk, of a bounded number of them; equal ones are encoded once."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, word: str) -> bytes:
        ids = self.encode(word)
        if len(word) <= SHORT:
            if len(self) >= CACHE_WORDS:
                self.clear()
            self[word] = ids
        return ids


def _pieces(text: str) -> Iterator[str]:
    """A long text in pieces that end before white space, where no word goes on."""
    start = 0
    while len(text) - start > PIECE_CHARS:
        space = _SPACE.search(text, start + PIECE_CHARS)
        end = space.start() if space else len(text)
        yield text[start:end]
        start = end
    yield text[start:] if start else text


@lru_cache(maxsize=2)
def load(path: str) -> Tokenizer:
    """Once per Python worker."""
    return Tokenizer(path)


def encode_documents(
    docs: DataFrame,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    carry: Sequence[str] = (),
    decoded: bool = False,
) -> DataFrame:
    """``id, ids`` and between them the columns to ``carry``: an array of the ids of each whole text.

    If ``decoded``, the ids are decoded again as they come out and the hash of
    that text is a last column ``decoded_sha256``. A null text counts as empty, without ids. No row moves. Rows that repeat an
    id are encoded each; an empty table gives an empty one.
    """

    def one(tokenizer: Tokenizer, text: str, hashes: list[str]) -> bytes:
        pieces = tokenizer.encode(text)
        if not decoded:
            return b"".join(pieces)
        text_hash, decoder, out = hashlib.sha256(), tokenizer.decoder(), []
        for data in pieces:
            out.append(data)
            if data:
                text_hash.update(decoder.feed(np.frombuffer(data, dtype="<u4").tolist()).encode())
        text_hash.update(decoder.finish().encode())
        hashes.append(text_hash.hexdigest())
        return b"".join(out)

    def run(batches):
        tokenizer = load(path)
        for batch in batches:
            hashes: list[str] = []
            found = [one(tokenizer, t.as_py() or "", hashes) for t in batch.column(1)]
            ends = np.cumsum([0, *(len(x) // 4 for x in found)])
            values = pa.array(np.frombuffer(b"".join(found), dtype="<u4").astype(np.int32))
            ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)
            columns = [batch.column(0), *batch.columns[2:], ids]
            columns += [pa.array(hashes, pa.string())] * decoded
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    named = docs.select(id_col, text_col, *carry)
    schema = T.StructType([f for f in named.schema if f.name != text_col]).add("ids", T.ArrayType(T.IntegerType()))
    if decoded:
        schema = schema.add("decoded_sha256", T.StringType())
    return map_batches(named, run, schema)


def decode_documents(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``id, text`` of arrays of ids; special tokens stay. Null ids count as none."""

    def run(batches):
        tokenizer = load(path)
        for batch in batches:
            texts = []
            for ids in batch.column("ids"):
                decoder = tokenizer.decoder()
                texts.append(decoder.feed(ids.as_py() or []) + decoder.finish())
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(texts, pa.string())], names=["id", "text"])

    named = encoded.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids"))
    kind = named.schema["id"].dataType.simpleString()
    return map_batches(named, run, f"id {kind}, text string").withColumnRenamed("id", id_col)


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, n_tokens, ids_sha256, decoded_sha256``: encodes whole texts and decodes the ids again.

    Both hashes are fed as ids and text come out, so neither is ever whole in memory.
    """

    def one(tokenizer: Tokenizer, text: str):
        ids_hash, text_hash, decoder, n = hashlib.sha256(), hashlib.sha256(), tokenizer.decoder(), 0
        for data in tokenizer.encode(text):
            ids_hash.update(data)
            n += len(data) // 4
            if data:
                text_hash.update(decoder.feed(np.frombuffer(data, dtype="<u4").tolist()).encode())
        text_hash.update(decoder.finish().encode())
        return n, ids_hash.hexdigest(), text_hash.hexdigest()

    def run(batches):
        tokenizer = load(path)
        for batch in batches:
            rows = [one(tokenizer, t.as_py() or "") for t in batch.column("text")]
            columns = [pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int64(), pa.string(), pa.string()))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), *columns], names=["id", "n_tokens", "ids_sha256", "decoded_sha256"]
            )

    named = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = named.schema["id"].dataType.simpleString()
    schema = f"id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return map_batches(named, run, schema).withColumnRenamed("id", id_col)
