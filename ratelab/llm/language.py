"""Language identification by words first, then ever shorter character n-grams.

A known word scores its log frequency in every language. A word the model
doesn't know falls back to its longest known n-grams: four characters, else
three, two, one. A text scores the mean over its words, whole and however long.
"""

from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratelab.llm.rows import quoted
from ratelab.llm.tasks import map_batches, ship_package

UNKNOWN = "und"
GRAMS = (4, 3, 2, 1)
#: An unlisted word with a listed n-gram of this length still counts as known.
KNOWN_GRAM = 3
#: A word, when learning and when predicting: a letter, then letters and combining marks.
WORD = regex.compile(r"\p{L}[\p{L}\p{M}]*")
INSIDE = regex.compile(r"[\p{L}\p{M}]{2}")
PIECE_CHARS = 1 << 20
#: Texts are scored together up to so many characters (or one longer text alone),
#: and so many of their words at a time.
TOGETHER_CHARS = 1 << 18
TOGETHER_WORDS = 1 << 16
#: Seed of ``xxhash64`` in Spark.
SEED = 42


@dataclass(frozen=True)
class FitRule:
    """``docs_per_language`` bounds the sample: about so many labelled documents of each
    language are learned from, chosen by a hash of id and text. All their words and
    n-grams are kept."""

    docs_per_language: int = 5_000
    smoothing: float = 0.5


@dataclass(frozen=True)
class Entries:
    """Words, or the n-grams of one length: which languages have them, and by how much more than those without.

    An entry goes by the XXH64 of its UTF-8; two that shared one would count as
    one. ``keys`` ascend; the languages of key i and their gains in log frequency
    are at ``starts[i]:starts[i + 1]``. A language's log frequency of an entry that
    it doesn't have is its ``default``. So the size goes by the counts that exist,
    not by entries times languages.
    """

    keys: np.ndarray
    starts: np.ndarray
    langs: np.ndarray
    gains: np.ndarray
    default: np.ndarray

    def find(self, entries: Sequence[str]) -> np.ndarray:
        """Each entry's place, -1 if it isn't listed."""
        asked = np.array([xxhash.xxh64_intdigest(e, SEED) for e in entries], dtype=np.uint64)
        if not len(self.keys):
            return np.full(len(asked), -1)
        at = np.minimum(np.searchsorted(self.keys, asked), len(self.keys) - 1)
        return np.where(self.keys[at] == asked, at, -1)

    def logs(self, entry: str) -> np.ndarray:
        """The entry's log frequency in every language."""
        out, at = self.default.copy(), int(self.find([entry])[0])
        if at >= 0:
            here = slice(self.starts[at], self.starts[at + 1])
            out[self.langs[here]] += self.gains[here]
        return out


@dataclass(frozen=True)
class LanguageModel:
    """Log frequencies of words and, for each length, of n-grams."""

    languages: tuple[str, ...]
    words: Entries
    grams: dict[int, Entries]


def fit_language_model(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    rule: FitRule = FitRule(),
) -> LanguageModel:
    """Learns from rows with a language; others are left out. Runs jobs.

    Each language gives every row the same chance, so that it brings about
    ``docs_per_language`` of them: only that bounded sample is counted. Of the
    counts the driver gets three numbers each, of no more words and n-grams than
    the sample has. Rows without an id are drawn by their text, equal rows
    together. An empty table gives a model without languages.
    """
    labelled = docs.select(
        quoted(id_col).alias("id"), quoted(lang_col).alias("lang"), quoted(text_col).alias("text")
    ).where("lang IS NOT NULL AND text IS NOT NULL")
    counts = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = tuple(sorted(counts))
    if not languages:
        nothing = _entries(pa.table({"key": [], "lang": [], "n": []}), 0, rule.smoothing)
        return LanguageModel((), nothing, dict.fromkeys(GRAMS, nothing))
    rates = _by_language(languages, (min(1.0, rule.docs_per_language / counts[lang]) for lang in languages))
    numbers = _by_language(languages, range(len(languages)))
    draw = F.pmod(F.xxhash64(F.col("id").cast("string"), "text", F.lit("fit")), F.lit(1 << 30)) / float(1 << 30)
    sample = labelled.where(draw < rates).select(numbers.alias("lang"), "text")
    counted = map_batches(sample, _counted, "lang int, entry string, n bigint")
    words = counted.groupBy("lang", "entry").agg(F.sum("n").alias("n")).persist()
    padded = F.concat(F.lit(" "), F.col("entry"), F.lit(" "))
    try:
        tables = [_collected(words, len(languages), rule.smoothing)]
        for size in GRAMS:
            starts = F.sequence(F.lit(1), F.length(padded) - (size - 1))
            grams = words.where(F.length(padded) >= size).select(
                "lang", F.explode(F.transform(starts, lambda i: F.substr(padded, i, F.lit(size)))).alias("entry"), "n"
            )
            tables.append(
                _collected(grams.groupBy("lang", "entry").agg(F.sum("n").alias("n")), len(languages), rule.smoothing)
            )
    finally:
        words.unpersist()
    return LanguageModel(languages, tables[0], dict(zip(GRAMS, tables[1:])))


def _by_language(languages, values) -> Column:
    return F.create_map(*(F.lit(x) for pair in zip(languages, values) for x in pair))[F.col("lang")]


def _collected(counts: DataFrame, languages: int, smoothing: float) -> Entries:
    numbers = counts.select(F.xxhash64("entry").alias("key"), "lang", "n")
    return _entries(numbers.toArrow(), languages, smoothing)


def _entries(counts: pa.Table, languages: int, smoothing: float) -> Entries:
    keys = counts["key"].to_numpy().astype(np.int64).view(np.uint64)
    langs = counts["lang"].to_numpy().astype(np.int32)
    n = counts["n"].to_numpy().astype(np.int64)
    order = np.lexsort((langs, keys))
    keys, langs, n = keys[order], langs[order], n[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, dtype=np.int64)
    # One place more than there are entries, for all that isn't listed.
    whole = np.bincount(langs, weights=n, minlength=languages) + smoothing * (len(first) + 1)
    return Entries(
        keys[first], np.r_[first, len(keys)], langs, np.log1p(n / smoothing), np.log(smoothing / whole)
    )


def word_counts(text: str | None) -> Counter[str]:
    """Lower-cased words of a whole text."""
    counts: Counter[str] = Counter()
    for piece in _pieces(text or ""):
        counts.update(WORD.findall(piece.lower()))
    return counts


def _counted(batches):
    for batch in batches:
        for lang, text in zip(batch.column("lang"), batch.column("text")):
            counts = word_counts(text.as_py())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang.as_py()] * len(counts), pa.int32()),
                    pa.array(list(counts), pa.string()),
                    pa.array(list(counts.values()), pa.int64()),
                ],
                names=["lang", "entry", "n"],
            )


class Scorer:
    """Predicts with a model, many texts together; keeps nothing from one call to the next."""

    def __init__(self, model: LanguageModel):
        self.model = model
        self.tables = (model.words, *(model.grams[size] for size in GRAMS))
        self.defaults = np.array([*(t.default for t in self.tables), np.zeros(len(model.languages))])

    def backoff(self, word: str) -> np.ndarray:
        """Mean log frequency of the longest n-grams of the word that the model lists."""
        for size in GRAMS:
            grams = _grams(word, size)
            listed = [g for g, at in zip(grams, self.model.grams[size].find(grams)) if at >= 0]
            if listed:
                return np.mean([self.model.grams[size].logs(g) for g in listed], axis=0)
        return np.zeros(len(self.model.languages))

    def predict(self, text: str | None) -> tuple[str, float]:
        return self.judge([text])[0][:2]

    def known_share(self, text: str | None) -> float:
        """Share of the words that are listed or have a listed n-gram of ``KNOWN_GRAM`` characters or more.

        Neither the number of languages nor how alike they are plays a part.
        """
        return self.judge([text])[0][2]

    def accepts(self, text: str | None, least_known: float) -> bool:
        """Whether the prediction is a language and the model knows that share of the words."""
        lang, _, known = self.judge([text])[0]
        return lang != UNKNOWN and known >= least_known

    def judge(self, texts: Sequence[str | None]) -> list[tuple[str, float, float]]:
        """Language, score and known share of each text."""
        out, group, chars = [], [], 0
        for text in texts:
            if group and chars + len(text or "") > TOGETHER_CHARS:
                out += self._together(group)
                group, chars = [], 0
            group.append(word_counts(text))
            chars += len(text or "")
        return out + self._together(group) if group else out

    def _together(self, counts: list[Counter[str]]) -> list[tuple[str, float, float]]:
        languages = len(self.model.languages)
        numbers: dict[str, int] = {}
        which = np.array([numbers.setdefault(w, len(numbers)) for c in counts for w in c], dtype=np.int64)
        if not languages or not len(which):
            return [(UNKNOWN, 0.0, 0.0)] * len(counts)
        times = np.array([n for c in counts for n in c.values()], dtype=float)
        text = np.repeat(np.arange(len(counts)), [len(c) for c in counts])
        kind, starts, langs, gains = self._resolve(list(numbers))
        shares = np.zeros((len(counts), len(self.defaults)))
        np.add.at(shares, (text, kind[which]), times)
        whole = shares.sum(axis=1)
        total = (shares @ self.defaults).ravel()
        for i in range(0, len(which), TOGETHER_WORDS):
            part = slice(i, i + TOGETHER_WORDS)
            at, of = _spread(starts[which[part]], starts[which[part] + 1])
            total += np.bincount(
                text[part][of] * languages + langs[at], weights=gains[at] * times[part][of], minlength=len(total)
            )
        mean = total.reshape(-1, languages) / np.maximum(whole, 1)[:, None]
        best = mean.argmax(axis=1)
        score = 1.0 / np.exp(mean - mean.max(axis=1)[:, None]).sum(axis=1)
        sizes = [KNOWN_GRAM, *GRAMS, 0]
        known = shares[:, [size >= KNOWN_GRAM for size in sizes]].sum(axis=1) / np.maximum(whole, 1)
        return [
            (self.model.languages[b], float(s), float(k)) if n else (UNKNOWN, 0.0, 0.0)
            for b, s, k, n in zip(best, score, known, whole)
        ]

    def _resolve(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of each word the table it is found in, and the languages that gain by it, as in ``Entries``.

        A word that none of whose n-grams is listed is in a last table, where no language gains.
        """
        kind = np.full(len(words), len(self.tables))
        found = self.model.words.find(words)
        parts = [(np.flatnonzero(found >= 0), found[found >= 0], np.ones(int((found >= 0).sum())))]
        kind[parts[0][0]] = 0
        left = np.flatnonzero(found < 0)
        for table, size in enumerate(GRAMS, start=1):
            grams = [_grams(words[i], size) for i in left]
            of = np.repeat(left, [len(g) for g in grams])
            places = self.model.grams[size].find([g for each in grams for g in each])
            of, places = of[places >= 0], places[places >= 0]
            kind[of] = table
            parts.append((of, places, 1.0 / np.bincount(of, minlength=len(words))[of]))
            left = left[kind[left] == len(self.tables)]
        word, langs, gains = [], [], []
        for entries, (of, places, weight) in zip(self.tables, parts):
            at, nth = _spread(entries.starts[places], entries.starts[places + 1])
            word.append(of[nth])
            langs.append(entries.langs[at])
            gains.append(entries.gains[at] * weight[nth])
        every = np.concatenate(word)
        order = np.argsort(every, kind="stable")
        starts = np.r_[0, np.cumsum(np.bincount(every, minlength=len(words)))]
        return kind, starts, np.concatenate(langs)[order], np.concatenate(gains)[order]


def _grams(word: str, size: int) -> list[str]:
    padded = f" {word} "
    return [padded[i : i + size] for i in range(len(padded) - size + 1)]


def _spread(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All places of the ranges one after another, and the number of the range each is from."""
    lengths = ends - starts
    of = np.repeat(np.arange(len(lengths)), lengths)
    return np.arange(len(of)) + (starts - (np.cumsum(lengths) - lengths))[of], of


def _pieces(text: str) -> Iterator[str]:
    """A long text in pieces that end between words."""
    start = 0
    while len(text) - start > PIECE_CHARS:
        end = start + PIECE_CHARS
        while end < len(text) and INSIDE.match(text, end - 1):
            end += 1
        yield text[start:end]
        start = end
    yield text[start:]


def predict_languages(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, lang_pred, score`` of every row; only the text decides.

    The language is one that was learned, ties go to the first in code point
    order, and the score is its share of the summed likelihoods per word. A
    text that is null or has no letter, and any text where nothing was learned,
    is ``und`` with score 0. Rows that repeat an id are predicted each.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        scorer = Scorer(shared.value)
        for batch in batches:
            found = scorer.judge(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    pa.array([lang for lang, _, _ in found], pa.string()),
                    pa.array([score for _, score, _ in found], pa.float64()),
                ],
                names=["id", "lang_pred", "score"],
            )

    named = docs.select(quoted(id_col).alias("id"), quoted(text_col).alias("text"))
    kind = named.schema["id"].dataType.simpleString()
    predicted = map_batches(named, run, f"id {kind}, lang_pred string, score double")
    return predicted.withColumnRenamed("id", id_col)


def keep_known_languages(
    docs: DataFrame, model: LanguageModel, least_known: float, text_col: str = "text"
) -> DataFrame:
    """The documents predicted to be in a language of whose words the model knows at least that share.

    Texts that are null or without a letter are ``und`` and go; so do all texts
    if nothing was learned. Rows are judged each, repeated ids or not, and keep
    all their columns, whatever their names; whole rows pass through once,
    nothing is shuffled. An empty table gives an empty table.
    """
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("boolean")
    def known(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Scorer(shared.value)
        for batch in texts:
            judged = scorer.judge(batch.tolist())
            yield pd.Series([lang != UNKNOWN and share >= least_known for lang, _, share in judged], dtype=bool)

    return docs.where(known(quoted(text_col)))
