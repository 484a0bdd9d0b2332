"""Toxicity of texts by a weighted finite-state grammar over clauses.

A lexicon, kept as a trie of stems, turns each word into a symbol of the grammar: insult (with a weight), threat, announcement,
target, negation, report, or plain. Five small transducers read the symbols of a clause side by side; each has a few states and puts
out a factor for each symbol. Their product scores a clause: an insult counts its weight, more beside a target, less
after a negation or in reported speech, and a threat counts where it is announced or has a target. A text has the
sum of its clauses' scores, the highest one and the number of its words as evidence, and a logistic curve makes a score of them.

Stems and curve are learnt from a bounded sample, SAMPLE labelled documents of each label by a hash of their id. A stem
becomes an insult when it is significantly more frequent in toxic texts, counted by the number of documents and of
different pairs of words it occurs in, whichever is less, so that a copied passage counts once. Half of the sample gives the
stems, the other half the curve. The words that are given below need no labels.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillflow.llm.common import SLICE_ROWS, materialise, unit, with_text_columns

SAMPLE = 4000  # labelled documents of each label that are learnt from, on average
THRESHOLD = 0.3
SHORTEST_STEM, LONGEST_STEM = 4, 10
LEAST_SUPPORT = 5  # documents and pairs of words in which a stem must occur
SIGNIFICANCE = 25.0  # log-likelihood ratio from which a stem is learnt
GIVEN_WEIGHT = 3.0

# Words of the grammar in English, German, French and Spanish. A star stands for any ending.
INSULTS = (
    "idiot* moron* loser* scum* stupid* imbecil* dumbass* bastard* asshole* "
    "idiotin dummkopf* trottel* arschloch* abschaum* versager* blödmann* "
    "imbécile* crétin* connard* abruti* débile* ordure* "
    "imbécil* estúpid* gilipollas escoria* pendej* cabrón*"
).split()
THREATS = (
    "kill* murder* strangle* stab* shoot* hurt* destroy* "
    "töten umbringen erschießen verprügeln erwürgen "
    "tuer tuerai étrangler poignarder frapper "
    "matar mataré apuñalar golpear"
).split()
ANNOUNCEMENTS = "will gonna shall must should ll werde wirst muss sollst vais va dois voy vas debes".split()
TARGETS = (
    "you your yours u he she they him her them this that these those such are is "
    "du dich dir dein deine ihr euch sie er ist sind bist "
    "tu te toi ton ta vous il elle ils est es êtes sont "
    "usted tú ti él ella ellos eres son"
).split()
NEGATIONS = "not no never nor neither isn aren wasn don doesn nicht kein keine nie pas jamais ne nunca jamás ni".split()
REPORTS = (
    "said says say wrote writes claimed quoted reported called calls allegedly "
    "sagte schrieb behauptete nannte angeblich "
    "dit écrit affirmé appelé prétendu "
    "dijo escribió afirmó llamó supuestamente"
).split()

PLAIN, INSULT, THREAT, ANNOUNCEMENT, TARGET, NEGATION, REPORT = range(7)
_WORD = re.compile(r"[^\W\d_]+")
# A clause ends at punctuation that closes one, at a line, and before the words that turn it.
_CLAUSE = re.compile(r"[.!?;:\r\n]+|, *(?=(?:but|aber|sondern|mais|pero|sino)\b)")


@dataclass(frozen=True)
class Transducer:
    """States 0 (the start) and up: what each symbol leads to, and the factor that it puts out in the state it is read in.

    What is not listed leads from state s to ``otherwise[s]`` and puts out the factor 1.
    """

    otherwise: tuple[int, ...]
    moves: dict[tuple[int, int], int]
    factors: dict[tuple[int, int], float]

    def step(self, state: int, symbol: int) -> tuple[int, float]:
        return self.moves.get((state, symbol), self.otherwise[state]), self.factors.get((state, symbol), 1.0)


def _fading(opener: int, reach: int, factors: dict[int, float]) -> Transducer:
    """A transducer whose opening symbol holds for the next ``reach`` words, over which the symbols have the factors."""
    states = range(1, reach + 1)
    moves = {(state, opener): 1 for state in range(reach + 1)}
    fade = (0, *[state + 1 if state < reach else 0 for state in states])
    return Transducer(fade, moves, {(state, symbol): f for state in states for symbol, f in factors.items()})


def _since(opener: int, factors: dict[int, float]) -> Transducer:
    """A transducer whose opening symbol holds to the end of the clause."""
    return Transducer((0, 1), {(0, opener): 1}, {(1, symbol): f for symbol, f in factors.items()})


#: The grammar. An announcement makes a threat of a verb, which alone weighs a tenth; a target before or behind raises both.
MACHINES = {
    "insult": Transducer((0, 0), {(0, INSULT): 1, (1, INSULT): 1}, {(1, INSULT): 1.2}),
    "threat": _fading(ANNOUNCEMENT, 4, {THREAT: 10.0}),
    "target": _fading(TARGET, 4, {INSULT: 1.3, THREAT: 2.0}),
    "negation": _fading(NEGATION, 3, {INSULT: 0.3, THREAT: 0.2}),
    "report": _since(REPORT, {INSULT: 0.5, THREAT: 0.3}),
}
#: Read from the end of the clause to its beginning.
BACKWARD = {"target behind": _fading(TARGET, 3, {INSULT: 1.1, THREAT: 2.0})}
_BASE = {THREAT: 0.1 * GIVEN_WEIGHT}


class Grammar:
    """The product of the transducers; its states and moves are made when they are first met."""

    def __init__(self, machines: dict[str, Transducer]) -> None:
        self.machines = tuple(machines.values())
        self.start = (0,) * len(self.machines)
        self.table: dict[tuple, list] = {}

    def step(self, state: tuple[int, ...], symbol: int) -> tuple[tuple[int, ...], float]:
        row = self.table.setdefault(state, [None] * 7)
        if row[symbol] is None:
            steps = [machine.step(s, symbol) for machine, s in zip(self.machines, state, strict=True)]
            row[symbol] = tuple(s for s, _ in steps), math.prod(f for _, f in steps)
        return row[symbol]

    def factors(self, symbols: list[tuple[int, float]]) -> list[float]:
        state, found = self.start, []
        for symbol, _ in symbols:
            state, factor = self.step(state, symbol)
            found.append(factor)
        return found


def clause_score(symbols: list[tuple[int, float]], forward: Grammar, backward: Grammar) -> float:
    """The score of a clause of symbols and weights: weight by weight, times what both directions put out for it."""
    ahead, behind = forward.factors(symbols), backward.factors(symbols[::-1])[::-1]
    return sum(weight * a * b for (_, weight), a, b in zip(symbols, ahead, behind, strict=True))


@dataclass
class Lexicon:
    """Symbols and weights of words: whole words and stems; the longest stem that a word begins with decides."""

    whole: dict[str, tuple[int, float]]
    stems: dict[str, tuple[int, float]]
    seen: dict[str, tuple[int, float]] = field(default_factory=dict)

    LIMIT = 200_000

    def __getitem__(self, word: str) -> tuple[int, float]:
        found = self.seen.get(word)
        if found is None:
            if len(self.seen) >= self.LIMIT:
                self.seen.clear()
            found = self.whole.get(word)
            for size in range(min(len(word), LONGEST_STEM), SHORTEST_STEM - 1, -1):
                found = found or self.stems.get(word[:size])
            found = self.seen[word] = found or (PLAIN, 0.0)
        return found

    def __getstate__(self) -> dict:
        return {"whole": self.whole, "stems": self.stems, "seen": {}}


def given_lexicon() -> Lexicon:
    """The words that are known without labels."""
    lexicon = Lexicon({}, {})
    for symbol, words in ((TARGET, TARGETS), (ANNOUNCEMENT, ANNOUNCEMENTS), (REPORT, REPORTS), (NEGATION, NEGATIONS), (THREAT, THREATS), (INSULT, INSULTS)):
        weight = {INSULT: GIVEN_WEIGHT}.get(symbol, _BASE.get(symbol, 0.0))
        for word in words:
            (lexicon.stems if word.endswith("*") else lexicon.whole)[word.rstrip("*")] = symbol, weight
    return lexicon


@dataclass
class Model:
    lexicon: Lexicon
    curve: np.ndarray  # of the features of a text: constant, sum, highest clause, density
    forward: Grammar = field(default_factory=lambda: Grammar(MACHINES))
    backward: Grammar = field(default_factory=lambda: Grammar(BACKWARD))

    def evidence(self, text: str | None) -> tuple[float, float, int]:
        """Sum of the clause scores, the highest one, and the number of words."""
        low = (text or "").lower()
        words, lexicon = _WORD.findall(low), self.lexicon
        if not any(lexicon[word][0] in (INSULT, THREAT) for word in set(words)):
            return 0.0, 0.0, len(words)
        total = highest = 0.0
        at = 0
        for edge in (*[m.span() for m in _CLAUSE.finditer(low)], (len(low), len(low))):
            symbols = [lexicon[word] for word in _WORD.findall(low, at, edge[0])]
            at = edge[1]
            if any(s in (INSULT, THREAT) for s, _ in symbols):
                score = clause_score(symbols, self.forward, self.backward)
                total, highest = total + score, max(highest, score)
        return total, highest, len(words)

    def score(self, evidence: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(_features(evidence) @ self.curve, -30, 30)))


def _features(evidence: np.ndarray) -> np.ndarray:
    total, highest, words = evidence.T
    return np.stack([np.ones(len(total)), np.log1p(total), np.minimum(highest, 10.0), np.log1p(100 * total / np.maximum(words, 1))], axis=1)


#: The curve where nothing was learnt: one given insult scores above THRESHOLD, a negated one below.
PLAIN_CURVE = np.array([-3.0, 1.0, 0.5, 0.0])


def _newton(x: np.ndarray, toxic: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Logistic regression with a small penalty on all but the constant."""
    curve, penalty = np.zeros(x.shape[1]), np.diag([1e-6, *[0.1] * (x.shape[1] - 1)])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ curve, -30, 30)))
        slope = x.T @ (weight * (p - toxic)) + penalty @ curve
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + penalty, slope)
        curve = curve - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return curve


def _fit_curve(evidence: np.ndarray, toxic: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """The curve of the features; one that would count against toxicity is left out, so that more evidence never lowers a score."""
    x = _features(evidence)
    used = list(range(x.shape[1]))
    while True:
        curve = _newton(x[:, used], toxic, weight)
        least = int(curve[1:].argmin()) + 1 if len(used) > 1 else 0
        if not least or curve[least] >= 0:
            found = np.zeros(x.shape[1])
            found[used] = curve
            return found
        del used[least]


def _labels(labels: DataFrame) -> DataFrame:
    """One row ``_id, toxic`` for each id; an id whose labels differ is left out, and so are nulls and other values."""
    known = labels.where("toxic IN (0, 1) AND doc_id IS NOT NULL")
    known = known.groupBy("doc_id").agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("most"))
    return known.where("toxic = most").select(F.col("doc_id").alias("_id"), "toxic")


def _sampled(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, dict[int, int]]:
    """Some SAMPLE documents of each label, all of a rarer one, as ``text, toxic, fit``; and the number of each label.

    The labels are sampled before they are joined, so what is broadcast is bounded by SAMPLE.
    """
    known = _labels(labels)
    sizes = {row["toxic"]: row["n"] for row in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = F.lit(0.0)
    for label, n in sizes.items():
        share = F.when(F.col("toxic") == label, min(1.0, SAMPLE / n)).otherwise(share)
    chosen = F.broadcast(known.where(unit(F.lit(12), F.col("_id")) < share))
    found = docs.select("doc_id", "text").where("text IS NOT NULL").join(chosen, F.col("doc_id") == F.col("_id"))
    return found.select("text", "toxic", (unit(F.lit(13), F.col("_id")) < 0.5).alias("fit")), sizes


def _stems(word: str) -> list[str]:
    return [word[:size] for size in range(SHORTEST_STEM, min(len(word), LONGEST_STEM) + 1)]


def _document_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many texts of each label a stem occurs; an empty stem counts the texts."""
    for batch in batches:
        counts: Counter = Counter()
        for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
            found = {stem for word in set(_WORD.findall(text.lower())) for stem in _stems(word)}
            counts.update((stem, toxic) for stem in found | {""})
        stems, toxics = zip(*counts, strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(stems), pa.array(toxics, pa.int32()), pa.array(list(counts.values()), pa.int64())], ["stem", "toxic", "n"])


def _likelihood_ratio(toxic: float, clean: float, all_toxic: int, all_clean: int) -> float:
    """Twice the log-likelihood ratio of a stem's shares in toxic and clean texts; 0 if it is no more frequent in toxic ones."""
    if toxic * all_clean <= clean * all_toxic:
        return 0.0

    def likelihood(hits: float, n: int, p: float) -> float:
        return (hits * math.log(p) if hits else 0.0) + ((n - hits) * math.log(1 - p) if n > hits else 0.0)

    both = (toxic + clean) / (all_toxic + all_clean)
    apart = likelihood(toxic, all_toxic, toxic / all_toxic) + likelihood(clean, all_clean, clean / all_clean)
    return 2 * (apart - likelihood(toxic, all_toxic, both) - likelihood(clean, all_clean, both))


def learn_stems(sample: DataFrame, taken: Lexicon) -> dict[str, tuple[int, float]]:
    """Stems of ``sample`` (``text, toxic``) that mark toxic texts, with their log-odds as weights.

    Candidates come from the counts of documents; the pairs of words they occur in are then counted in the toxic texts. Of
    stems that continue each other in the same documents the longest is kept. Words of the given lexicon stay what they are.
    """
    counted = sample.mapInArrow(_document_counts, "stem string, toxic int, n bigint").groupBy("stem")
    counted = counted.agg(F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("t"), F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("c"))
    kept = counted.where((F.col("stem") == "") | (F.col("t") >= LEAST_SUPPORT)).toArrow()  # of the bounded sample
    counts = {r["stem"]: (r["t"], r["c"]) for r in kept.to_pylist()}
    all_toxic, all_clean = counts.pop("", (0, 0))
    if not all_toxic or not all_clean:
        return {}
    candidates = {s: n for s, n in counts.items() if _likelihood_ratio(*n, all_toxic, all_clean) >= SIGNIFICANCE}

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = set()
            for text in batch.column("text").to_pylist():
                words = _WORD.findall(text.lower())
                for word, after in zip(words, [*words[1:], ""], strict=True):
                    found.update((stem, f"{word} {after}") for stem in _stems(word) if stem in candidates)
            yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], pa.string()) for i in (0, 1)], ["stem", "pair"])

    uses = sample.where("toxic = 1").select("text").mapInArrow(pairs, "stem string, pair string").distinct()
    support = {r["stem"]: r["n"] for r in uses.groupBy("stem").agg(F.count(F.lit(1)).alias("n")).collect()}
    found = {}
    for stem, (toxic, clean) in candidates.items():
        least = min(toxic, support.get(stem, 0))
        if least >= LEAST_SUPPORT and _likelihood_ratio(least, clean, all_toxic, all_clean) >= SIGNIFICANCE:
            found[stem] = math.log((least + 0.5) / (all_toxic + 1)) - math.log((clean + 0.5) / (all_clean + 1))
    continued = {stem[:-1] for stem in found if counts[stem] == counts.get(stem[:-1])}
    return {stem: (INSULT, weight) for stem, weight in found.items() if stem not in continued and stem not in taken.whole}


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """The lexicon and the curve from ``docs`` (``doc_id, text``) and ``labels`` (``doc_id, toxic``)."""
    model = Model(given_lexicon(), PLAIN_CURVE)
    sample, sizes = _sampled(docs, labels)
    sample = materialise(sample)
    model.lexicon.stems |= learn_stems(sample.where("fit").select("text", "toxic"), model.lexicon)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = zip(*[model.evidence(text) for text in batch.column("text").to_pylist()], strict=True)
            columns = [pa.array(column, pa.float64()) for column in found]
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), *columns], ["toxic", "total", "highest", "words"])

    rest = sample.where("NOT fit").select("text", "toxic").mapInArrow(weigh, "toxic int, total double, highest double, words double")
    rows = np.array([tuple(r) for r in rest.collect()])  # of the bounded sample
    if len(rows) and 0 < rows[:, 0].sum() < len(rows):
        toxic = rows[:, 0]
        share = sizes[1] / (sizes[0] + sizes[1])
        weight = np.where(toxic == 1, share / toxic.mean(), (1 - share) / (1 - toxic.mean()))
        model.curve = _fit_curve(rows[:, 1:], toxic, weight)
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``clause_sum, clause_most, score``; the score rises with the evidence and reads as a probability.

    A null or empty text and one without insult or threat have the score of no evidence. Repeated rows score alike, an empty
    table gives an empty result, other columns are kept, and columns with the added names are replaced. A very long text
    is read whole, clause by clause.
    """

    def compute(column: pa.Array) -> Iterator[list[pa.Array]]:
        for at in range(0, len(column), SLICE_ROWS):
            found = np.array([model.evidence(text) for text in column.slice(at, SLICE_ROWS).to_pylist()], np.float64)
            yield [pa.array(found[:, 0]), pa.array(found[:, 1]), pa.array(model.score(found))]

    return with_text_columns(docs, dict.fromkeys(["clause_sum", "clause_most", "score"], "double"), compute)


def fold(doc_id: Column) -> Column:
    """The fold of a document; 2 is held out."""
    return F.crc32(doc_id.cast("string")) % 4


def learn_and_score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Learn from the labelled documents outside the held-out fold, then score all; adds ``held_out, predicted`` too."""
    docs = docs.drop("held_out", "predicted")
    model = train(docs, labels.where(fold(F.col("doc_id")) != 2))
    held_out = F.coalesce(fold(F.col("doc_id")) == 2, F.lit(False))
    return score(docs, model).withColumns({"held_out": held_out, "predicted": (F.col("score") >= THRESHOLD).cast("int")})
