"""Toxicity by a weighted finite-state grammar over clauses.

Five small transducers read the symbols of a clause: insults, threats, targets, negation and reported speech.
Their product is one table of states. An insult gives its learned weight, changed by what the other machines
have read; a threat needs a target. Clause scores feed a small logistic model, so isolated words that the
grammar plays down count for less.

Insult words and stems are learned from a bounded sample of labelled texts, by the number of different contexts
(the word before and after) in which they occur: copies of a text add no context.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillcast.llm.common import add_columns, bounded_sample, chunks, held_out
from tillcast.session import materialise

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, END = range(7)

# Words of the closed classes in English, German, French and Spanish.
THREATS = "kill hurt destroy beat shoot stab burn punish töten verletzen schlagen vernichten tuer frapper détruire blesser matar golpear destruir herir"
TARGETS = "you your he she they him her them his their du dich dir ihr euch er sie ihn tu toi te vous il elle ils eux tú usted ustedes ellos ella él"
NEGATIONS = "not no never nor neither without nicht kein keine nie niemals ohne ne pas jamais sans aucun nunca jamás ni sin tampoco"
REPORTS = "said says say called calls quoted quote wrote claimed alleged reported sagte sagt nannte schrieb behauptete dit disait appelé écrit dijo dice llamó escribió"

TOKEN = re.compile(r"[^\W\d_]+|[.!?;\n]")
WORD = re.compile(r"[^\W\d_]+")


@dataclass(frozen=True)
class Settings:
    """``toxic``, ``clean``: sample of labelled rows of each kind (at most twice that many). ``entries``: bound of
    the lexicon's words, and of its stems. ``evidence``: least log-likelihood ratio of an entry."""

    toxic: int = 3_000
    clean: int = 6_000
    entries: int = 4_000
    evidence: float = 30.0
    least_odds: float = 2.0
    stem: tuple[int, int] = (4, 8)


@dataclass(frozen=True)
class Machine:
    """A transducer: unlisted symbols keep the state, a clause end leads back to state 0.

    ``factors`` scale what is emitted in a state, ``adds`` are emitted by a symbol in a state."""

    states: int
    moves: dict
    factors: dict = field(default_factory=dict)
    adds: dict = field(default_factory=dict)


INSULTS = Machine(1, {})
AIMED = Machine(2, {(0, TARGET): 1}, factors={1: 1.25})
NEGATED = Machine(2, {(0, NEGATION): 1}, factors={1: 0.3})
REPORTED = Machine(2, {(0, REPORT): 1}, factors={1: 0.5})
MENACE = Machine(2, {(0, THREAT): 1, (1, TARGET): 0}, adds={(1, TARGET): 1.0})


def compose(machines: list[Machine]) -> tuple[list[list[int]], list[float], list[list[float]]]:
    """The product: next state by state and symbol, factor by state, weight added by state and symbol."""
    start = (0,) * len(machines)
    index, queue = {start: 0}, [start]
    moves, factors, adds = [], [], []
    for state in queue:
        row, added = [], []
        for symbol in range(END + 1):
            then = start if symbol == END else tuple(m.moves.get((s, symbol), s) for m, s in zip(machines, state))
            if then not in index:
                index[then] = len(index)
                queue.append(then)
            row.append(index[then])
            added.append(sum(m.adds.get((s, symbol), 0.0) for m, s in zip(machines, state)))
        moves.append(row)
        adds.append(added)
        factors.append(math.prod(m.factors.get(s, 1.0) for m, s in zip(machines, state)))
    return moves, factors, adds


GRAMMAR = compose([INSULTS, AIMED, NEGATED, REPORTED, MENACE])
CLOSED = {w: s for s, ws in ((TARGET, TARGETS), (THREAT, THREATS), (NEGATION, NEGATIONS), (REPORT, REPORTS)) for w in ws.split()}


@dataclass
class ToxicityModel:
    """``words`` and ``stems`` with weights; ``beta`` of the logistic model; ``mean`` and ``scale`` of its features."""

    words: dict[str, float]
    stems: dict[str, float]
    beta: np.ndarray
    stem: tuple[int, int]

    def scorer(self) -> Scorer:
        return Scorer(self)


class Scorer:
    #: Words that a task remembers.
    REMEMBERED = 500_000

    def __init__(self, model: ToxicityModel):
        self.model, self.weights = model, {}

    def weight(self, word: str) -> float:
        """Weight of the whole word or of its longest listed stem."""
        found = self.model.words.get(word)
        if found is None:
            lo, hi = self.model.stem
            found = next((x for n in range(min(hi, len(word) - 1), lo - 1, -1) if (x := self.model.stems.get(word[:n]))), 0.0)
        return found

    def features(self, texts: list[str | None]) -> np.ndarray:
        """For each text: a constant, the logarithm of all weight, the best clause, and the matched clauses."""
        out = np.zeros((len(texts), 4))
        out[:, 0] = 1
        known = self.weights
        for i, text in enumerate(texts):
            if not text:
                continue
            lower = text.lower()
            found = set(WORD.findall(lower))
            new = found.difference(known)
            if new:
                if len(known) > self.REMEMBERED:
                    known.clear()
                    new = found
                for w in new:
                    known[w] = self.weight(w)
            if any(map(known.__getitem__, found)) or not found.isdisjoint(_MENACES):
                scores = self.clauses(lower)
                out[i, 1:] = math.log1p(sum(scores)), min(max(scores, default=0.0), 20.0), min(len(scores), 5)
        return out

    def clauses(self, lower: str) -> list[float]:
        """Scores of the clauses that the grammar matches."""
        moves, factors, adds = GRAMMAR
        state, total, out, weights = 0, 0.0, [], self.weights
        for token in TOKEN.findall(lower):
            weight = weights.get(token, 0.0)
            symbol = INSULT if weight else CLOSED.get(token, END if token in ".!?;\n" else OTHER)
            if symbol == OTHER:
                continue
            total += factors[state] * (weight + adds[state][symbol])
            state = moves[state][symbol]
            if symbol == END and total:
                out.append(total)
                total = 0.0
        return [*out, total] if total else out

    def __call__(self, texts: list[str | None]) -> tuple[list, list]:
        z = self.features(texts) @ self.model.beta
        score = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        return score.tolist(), (score >= 0.5).astype(int).tolist()


_MENACES = set(THREATS.split())


def _contexts(sample: DataFrame) -> DataFrame:
    """(word, toxic, context): each different pair of neighbours of a word, by label."""

    def run(batches):
        import pyarrow as pa
        import xxhash

        for batch in batches:
            for part in chunks(batch, "text", 1_000_000):
                seen = set()
                for text, toxic in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    words = ["", *WORD.findall((text or "").lower()), ""]
                    seen.update((w, toxic, xxhash.xxh64_intdigest(f"{a} {b}") >> 1) for a, w, b in zip(words, words[1:], words[2:]))
                if seen:
                    word, toxic, context = zip(*seen)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(word, pa.string()), pa.array(toxic, pa.int32()), pa.array(context, pa.int64())], names=["word", "toxic", "context"],
                    )

    return sample.select("text", "toxic").mapInArrow(run, "word string, toxic int, context long").distinct()


def _ratio(t, c, all_t: float, all_c: float):
    """Log odds and log-likelihood ratio of t toxic and c clean contexts, as expressions."""
    odds = F.log((t + 0.5) / (all_t + 1)) - F.log((c + 0.5) / (all_c + 1))
    share = all_t / (all_t + all_c)

    def part(n, expected):
        return F.when(n > 0, n * F.log(n / expected)).otherwise(0.0)

    return odds, 2 * (part(t, (t + c) * share) + part(c, (t + c) * (1 - share)))


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", column: str = "text", label: str = "toxic", settings: Settings = Settings()) -> ToxicityModel:
    """Learns lexicon and logistic model from labelled rows whose key is not held out.

    Null labels and keys teach nothing; of several labels of a key the largest counts. Equal texts of the sample
    count once. Without toxic rows nothing is toxic.
    """
    spark = docs.sparkSession
    known = labels.select(F.col(key).alias("key"), F.col(label).cast("int").alias("toxic")).where("key is not null and toxic is not null")
    known = known.where(~held_out("key")).groupBy("key").agg(F.max("toxic").alias("toxic"))
    chosen = bounded_sample(known.where("toxic = 1"), "key", settings.toxic).unionByName(bounded_sample(known.where("toxic = 0"), "key", settings.clean))
    texts = docs.select(F.col(key).alias("key"), F.col(column).cast("string").alias("text")).where("text is not null")
    most = 4 * (settings.toxic + settings.clean)
    sample = texts.join(F.broadcast(chosen), "key").select("text", "toxic").limit(most)  # chosen has at most 2 x the sample's rows
    sample = sample.groupBy("text").agg(F.max("toxic").alias("toxic")).repartition(spark.sparkContext.defaultParallelism)
    sample = materialise(sample, "labelled")
    # seeded, so that workers of one job agree on hash(): the context column is made distinct across them
    counts = materialise(_contexts(sample).groupBy("word").agg(F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("c")), "contexts")
    totals = counts.agg(F.coalesce(F.sum("t"), F.lit(0)).alias("t"), F.coalesce(F.sum("c"), F.lit(0)).alias("c")).first()
    t, c = F.col("t"), F.col("c")
    odds, evidence = _ratio(t, c, float(totals.t), float(totals.c) or 1.0)
    strong = counts.withColumn("odds", odds).withColumn("evidence", evidence)
    wanted = (F.col("evidence") >= settings.evidence) & (F.col("odds") >= settings.least_odds)
    words = strong.where(wanted & (F.length("word") > 2)).orderBy(F.desc("evidence"), "word").limit(settings.entries).select("word", "odds").collect()
    lo, hi = settings.stem
    cut = F.explode(F.sequence(F.lit(lo), F.least(F.lit(hi), F.length("word") - 1)))
    stems = counts.where(F.length("word") > lo).withColumn("n", cut).groupBy(F.expr("substring(word, 1, n)").alias("stem")).agg(
        F.sum("t").alias("t"), F.sum("c").alias("c"), F.count_if(t >= 2).alias("kinds"),
    )
    stems = stems.withColumn("odds", odds).withColumn("evidence", evidence).where(wanted & (F.col("kinds") >= 4) & (c <= 0.02 * t))
    stems = stems.orderBy(F.desc("evidence"), "stem").limit(settings.entries).select("stem", "odds").collect()
    model = ToxicityModel(dict(map(tuple, words)), dict(map(tuple, stems)), np.array([-3.0, 0, 0, 0]), settings.stem)
    shared = spark.sparkContext.broadcast(model)

    def make():
        scorer = shared.value.scorer()
        return lambda texts: [scorer.features(texts).tolist()]

    rows = add_columns(sample, "text", make, [T.StructField("x", T.ArrayType(T.DoubleType()))]).select("x", "toxic").collect()  # a bounded sample
    if rows and model.words:
        model.beta = _logistic(np.array([r.x for r in rows]), np.array([r.toxic for r in rows], float))
    shared.unpersist()
    return model


def _logistic(x: np.ndarray, y: np.ndarray, penalty: float = 0.5, steps: int = 50) -> np.ndarray:
    """Ridge logistic regression by Newton steps; the constant is not penalised."""
    ridge = np.diag([1e-6] + [penalty] * (x.shape[1] - 1))
    beta = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        slope = x.T @ (y - p) - ridge @ beta
        curve = (x * (p * (1 - p))[:, None]).T @ x + ridge
        move = np.linalg.solve(curve, slope)
        beta = beta + np.clip(move, -2, 2)
        if np.abs(move).max() < 1e-6:
            break
    return beta


def score_toxicity(docs: DataFrame, model: ToxicityModel, column: str = "text") -> DataFrame:
    """``docs`` with score (0 to 1) and predicted (1 from 0.5 on). Null and empty texts get the score of a text
    without matches. New columns replace clashing ones."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    fields = [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]
    return add_columns(docs, column, lambda: shared.value.scorer(), fields)
