"""Toxicity: a weighted lexicon matched by Aho-Corasick on folded text."""

from __future__ import annotations

import math
import re
import unicodedata
from bisect import bisect_right
from collections import Counter
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import fitting
from tidemark.llm import text as T
from tidemark.sources.storage import scratch_path, shared_dir

# Stems that count before anything is learned, with one weight for all.
SEED = ("bastard", "clown", "disgusting", "idiot", "imbecile", "loser", "moron", "pathetic", "scum", "stupid", "trash", "worthless")
SEED_WEIGHT = 3.0
# Phrases in which a stem is harmless.
EXCEPTIONS = (
    "clown fish", "class clown", "circus clown", "trash can", "trash bin", "trash bag", "trash collection",
    "pond scum", "soap scum", "idiot proof", "sore loser", "worthless check",
)
THRESHOLD = 0.3
#: Lengths of the stems that are learned, in letters.
STEM = (3, 12)
LEAST_DOCS = 4
#: Beginnings of words that are weighed as stems at most, the most frequent ones.
MOST_STEMS = 200_000

# Letters of other scripts that look like Latin ones.
_LOOKALIKES = str.maketrans(
    "аеорсхуіјѕһԁԛԝкмтвнгαεορνικτυχ",
    "aeopcxyijshdqwkmtbhraeopviktux",
)
_DIGITS = str.maketrans("013457@$!|", "oieastasii")
_OTHER = re.compile(r"[^\x00-\u024f]")
_ACCENTED = re.compile(r"[\u00c0-\u024f\u1e00-\u1eff]+")
_SIGNS = "013457@$"
_MIXED = re.compile(rf"[{_SIGNS}!|]+")
_WORD = re.compile(r"[^\W\d_]+")
_SOME = re.compile(r"\S")


def _fold_table() -> dict:
    table: dict[int, str | None] = dict(_LOOKALIKES)
    # Full-width and mathematical letters by their compatibility form; marks and joiners vanish.
    for cp in [*range(0xFF21, 0xFF5B), *range(0x1D400, 0x1D7FF), *range(0x2100, 0x2150)]:
        plain = unicodedata.normalize("NFKC", chr(cp))
        if plain != chr(cp) and plain.isalpha():
            table[cp] = plain.lower()
    for cp in [*range(0x300, 0x370), *range(0x200B, 0x2010), 0x2060, 0xFEFF]:
        table[cp] = None
    return table


def _accent_table() -> dict:
    """Accented Latin letters as the letter that their decomposition begins with."""
    table = {}
    for cp in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)]:
        letter = unicodedata.normalize("NFD", chr(cp))[0].lower()
        if letter != chr(cp) and "a" <= letter <= "z":
            table[cp] = "i" if letter == "l" else letter
    return table


_FOLD, _ACCENTS = _fold_table(), _accent_table()


def _letters(run: re.Match) -> str:
    """A run of digits and signs as letters where it touches some; ! and | only between letters."""
    signs, text = run[0], run.string
    before = run.start() > 0 and text[run.start() - 1].isalpha()
    after = run.end() < len(text) and text[run.end()].isalpha()
    if before and after:
        return signs.translate(_DIGITS)
    if before:
        rest = signs.lstrip(_SIGNS)
        return signs[: len(signs) - len(rest)].translate(_DIGITS) + rest
    if after:
        rest = signs.rstrip(_SIGNS)
        return rest + signs[len(rest) :].translate(_DIGITS)
    return signs


def fold(text: str) -> str:
    """Lower case, lookalike letters as Latin ones, signs in words as the letters they stand for.

    The letters i and l, the digit 1 and the signs ! and | look alike: inside a
    word they all are i. Runs of blanks are one space.
    """
    text = text.lower()
    if _OTHER.search(text):
        text = text.translate(_FOLD)
    text = _MIXED.sub(_letters, text)
    return " ".join(text.replace("l", "i").split())


def bare(folded: str) -> str:
    """A folded text, letter by letter without accents; itself where it has none."""
    return _ACCENTED.sub(lambda m: m[0].translate(_ACCENTS), folded)


@dataclass(frozen=True)
class Model:
    """Stems with weights, exception phrases, and the coefficients of the score."""

    stems: tuple[tuple[str, float], ...]
    exceptions: tuple[str, ...]
    beta: tuple[float, ...]


class Matcher:
    """Finds stems at the start of words, all at once; exceptions hide what they cover."""

    def __init__(self, stems, exceptions):
        self.automaton = ahocorasick.Automaton()
        self.exceptions = tuple(map(fold, exceptions))
        for phrase in self.exceptions:
            self.automaton.add_word(phrase, (len(phrase), None, True))
        seeds = tuple(map(fold, SEED))
        for stem, weight in stems:
            stem = fold(stem)
            loose = any(seed.startswith(stem) or stem.startswith(seed) for seed in seeds)
            self.automaton.add_word(stem, (len(stem), weight, loose))
        self.some = len(self.automaton) > 0
        if self.some:
            self.automaton.make_automaton()

    def hits(self, folded: str) -> list[tuple[int, int, float]]:
        """(start, end, weight) in the folded text, the longest stem of a word only.

        Words match as they are; the seed's and exceptions also without accents.
        Learned stems do not: accents tell words of other languages apart. Both
        forms have the same places.
        """
        if not self.some:
            return []
        hidden, found = [], {}
        plain = bare(folded)
        for form in (folded,) if plain == folded else (folded, plain):
            for last, (size, weight, loose) in self.automaton.iter(form):
                start = last + 1 - size
                if start and form[start - 1].isalpha() or form is not folded and not loose:
                    continue
                if weight is None:
                    if last + 1 == len(form) or not form[last + 1].isalpha():
                        hidden.append((start, last + 1))
                elif start not in found or found[start][0] < last + 1:
                    found[start] = last + 1, weight
        if not hidden:
            return [(s, e, w) for s, (e, w) in sorted(found.items())]
        hidden.sort()
        begins, ends, far = [a for a, _ in hidden], [], 0
        for _, b in hidden:
            far = max(far, b)
            ends.append(far)
        out = []
        for s, (e, w) in sorted(found.items()):
            at = bisect_right(begins, s) - 1
            if at < 0 or ends[at] < e:
                out.append((s, e, w))
        return out


def _pieces(text: str, exceptions=(), size: int = T.PIECE):
    """A long text in pieces cut at blanks, outside of exception phrases, for folding piece by piece."""
    at, far = 0, 2 * max(map(len, exceptions), default=0) + 2
    while len(text) - at > size:
        end = text.find(" ", at + size)
        while end >= 0:
            after = _SOME.search(text, end)
            if not after:
                end = -1
                break
            before = fold(text[at:end].rstrip()[-far:])
            around = f"{before} {fold(text[after.start() : after.start() + far])}"
            if not any(p in around for p in exceptions):
                break
            end = text.find(" ", after.start() + far)
        if end < 0:
            break
        yield text[at:end]
        at = end
    yield text[at:] if at else text


def feature(text: str, matcher: Matcher) -> float:
    """Weight of all hits over the root of the number of words."""
    weight, words = 0.0, 0
    for piece in _pieces(text, matcher.exceptions):
        weight += sum(h[2] for h in matcher.hits(fold(piece)))
        words += len(piece.split())
    return math.log1p(max(0.0, weight) / math.sqrt(words + 1))


def train(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    label_col: str = "toxic", train_rows: Column | None = None, sample: int = fitting.SAMPLE,
    exceptions=EXCEPTIONS,
) -> Model:
    """Learn stems and score from at most ``sample`` labelled rows.

    A stem is the beginning of a word whose share of toxic documents is surely
    above that of others: its log ratio less two standard errors counts. Of the
    beginnings of one word the most telling stays. Seed stems stay unless the
    labels speak against them. At most ``MOST_STEMS`` beginnings and one number
    per row of the sample come to the driver. Without labels the seed and a fixed score are used.
    """
    spark = docs.sparkSession
    shared_dir(spark)
    rows = fitting.labelled(
        docs, labels, label_col, id_col, text_col, scratch_path(spark, "toxicity"), train_rows, sample
    )
    sizes = dict(rows.groupBy("label").count().collect())
    bad, good = sizes.get(1, 0), sizes.get(0, 0)
    if not bad or not good:
        return Model(tuple((s, SEED_WEIGHT) for s in SEED), tuple(exceptions), (-4.0, 4.0))

    def counted(wanted):
        def count(batches):
            n = Counter()
            for batch in T.slices(batches):
                for text in batch.column(0).to_pylist():
                    seen = set()
                    for piece in _pieces(text):
                        for word in set(_WORD.findall(fold(piece))):
                            seen.update(word[:k] for k in range(STEM[0], min(len(word), STEM[1]) + 1))
                    n.update(seen if wanted is None else seen & wanted.value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(n), pa.string()), pa.array(list(n.values()), pa.int64())], ["stem", "n"]
            )

        return count

    schema = "stem string, n bigint"
    seen = rows.where("label = 1").select("text").mapInArrow(counted(None), schema)
    often = seen.groupBy("stem").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_DOCS)
    often = often.orderBy(F.desc("n"), "stem").limit(MOST_STEMS)
    toxic = dict(often.toPandas().itertuples(index=False))
    wanted = spark.sparkContext.broadcast(frozenset(toxic) | frozenset(map(fold, SEED)))
    clean = rows.where("label = 0").select("text").mapInArrow(counted(wanted), schema)
    other = dict(clean.groupBy("stem").agg(F.sum("n").alias("n")).toPandas().itertuples(index=False))
    wanted.unpersist()
    stems = choose_stems(toxic, other, bad, good)
    model = Model(stems, tuple(exceptions), ())
    shared = spark.sparkContext.broadcast(model)

    def features(batches):
        matcher = Matcher(shared.value.stems, shared.value.exceptions)
        for batch in T.slices(batches):
            x = [feature(t, matcher) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(x, pa.float64())], ["label", "x"])

    points = rows.select("label", "text").mapInArrow(features, "label int, x double").toArrow()
    beta = fitting.logistic(
        points.column("x").to_numpy()[:, None], points.column("label").to_numpy().astype(float)
    )
    return Model(stems, tuple(exceptions), tuple(beta.tolist()))


def choose_stems(toxic: dict, other: dict, bad: int, good: int) -> tuple[tuple[str, float], ...]:
    rated = []
    for stem, a in toxic.items():
        b = other.get(stem, 0)
        weight = math.log((a + 0.5) / (bad + 1)) - math.log((b + 0.5) / (good + 1))
        if weight - 2 * math.sqrt(1 / (a + 0.5) + 1 / (b + 0.5)) >= 1.5:
            rated.append((a * weight, len(stem), stem, weight))
    chosen: dict[str, float] = {}
    begun: set[str] = set()
    for _, _, stem, weight in sorted(rated, key=lambda r: (-r[0], -r[1], r[2])):
        if stem in begun or any(stem[:k] in chosen for k in range(STEM[0], len(stem))):
            continue
        chosen[stem] = min(weight, 8.0)
        begun.update(stem[:k] for k in range(STEM[0], len(stem)))
    for stem in map(fold, SEED):
        covered = any(stem[:k] in chosen for k in range(STEM[0], len(stem) + 1))
        if not covered and toxic.get(stem, 0) * good >= other.get(stem, 0) * bad:
            chosen[stem] = SEED_WEIGHT
    return tuple(sorted(chosen.items()))


def score(
    docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """``doc_id``, ``score`` (0 to 1) and ``predicted`` (score at the threshold or above) of every row.

    Null and empty texts score like a text without hits. Whole texts count, in
    pieces of bounded size. Repeated rows stay; an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    run = _scorer(shared, 1)

    def both(batches):
        for batch in T.slices(batches):
            s = run(batch)
            flag = pa.array([int(x >= threshold) for x in s], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(s, pa.float64()), flag], ["doc_id", "score", "predicted"]
            )

    return T.narrow(docs, id_col, text_col).mapInArrow(both, "doc_id bigint, score double, predicted int")


def _scorer(shared, column: int):
    held: list[Matcher] = []

    def run(batch) -> np.ndarray:
        model = shared.value
        if not held:
            held.append(Matcher(model.stems, model.exceptions))
        x = np.array([feature(t or "", held[0]) for t in batch.column(column).to_pylist()])
        return fitting.probability(x[:, None], np.array(model.beta))

    return run


def reject(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows, unchanged, whose text scores below the threshold."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    run = _scorer(shared, docs.columns.index(text_col))

    def keep(batches):
        for batch in T.slices(batches):
            yield batch.filter(pa.array(run(batch) < threshold))

    return docs.mapInArrow(keep, docs.schema)
