"""Toxicity by a weighted finite-state pattern grammar.

Five transducers are composed into one machine over word classes.  The lexicon turns words into classes: insults and
threats (stems with weights, learnt from labelled rows or given), targets, negations and words of reported speech.
The target transducer marks insults and threats that have someone near them, the negation transducer those within
reach of a negation, the reported-speech transducer those that a clause only reports; a last one weighs what is left
of each mark.  The composed machine reads the clauses that hold an insult or a threat, word by word, and a clause
scores what the machine emits.  A logistic map of the clause scores, fitted on labelled rows, gives the probability.

Defined results: null, empty and matchless texts get the probability of no match; without labelled toxic rows only the
given words match; repeated rows get equal scores; other columns pass through.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlens.llm.labelled import PER_CLASS, logistic, sample, sigmoid
from churnlens.llm.textops import slices, small_batches

# Word classes.
INSULT, THREAT, TARGET, NEGATION, REPORT, OTHER = "insult", "threat", "target", "negation", "report", "other"
#: Given words (lower case) in the languages of the corpus.
WORDS = {
    INSULT: "idiot idiots moron morons stupid dumb loser losers scum pathetic worthless disgusting",
    THREAT: "kill hurt destroy strangle töten umbringen tuer matar",
    TARGET: "you your yours he she they them du dich dir ihr euch tu te toi vous usted ustedes",
    NEGATION: "not no never isn't aren't don't nicht kein keine nie ne pas jamais nunca",
    REPORT: "said says claimed reported wrote sagte sagt schrieb dit écrit dijo dice",
}
GIVEN_WEIGHT = 3.0
REACH = 3  # words over which a target or a negation acts
LENGTHS = range(4, 9)  # lengths of the stems tried; whole words are tried too
MOST_STEMS = 2000  # stems weighed on the driver at most


class Transducer:
    """A deterministic machine: ``step(state, symbol)`` gives (state, symbol out).  States are small and finite."""

    def __init__(self, start, step):
        self.start, self.step = start, step

    def compose(self, other: "Transducer") -> "Transducer":
        """The machine that feeds this one's output to ``other``."""
        def step(state, symbol):
            a, out = self.step(state[0], symbol)
            b, out = other.step(state[1], out)
            return (a, b), out
        return Transducer((self.start, other.start), step)


def _reach(trigger: str, mark: str) -> Transducer:
    """Marks insults and threats up to ``REACH`` words after a trigger."""
    def step(left, symbol):
        kind, marks = symbol
        if kind == trigger:
            return REACH, symbol
        if kind in (INSULT, THREAT):
            return max(left - 1, 0), (kind, marks | {mark}) if left else symbol
        return max(left - 1, 0), symbol
    return Transducer(0, step)


def _target() -> Transducer:
    """Marks insults and threats with a target up to ``REACH`` words before them, and targets that soon after one."""
    def step(state, symbol):
        kind, marks = symbol
        target, hit, what = state
        aims = {what} if kind == TARGET and hit else {"target"} if kind in (INSULT, THREAT) and target else set()
        if kind in (INSULT, THREAT):
            state = max(target - 1, 0), REACH, kind
        elif kind == TARGET:
            state = REACH, 0, None
        else:
            state = max(target - 1, 0), max(hit - 1, 0), what if hit > 1 else None
        return state, (kind, marks | aims)
    return Transducer((0, 0, None), step)


def _report() -> Transducer:
    """Marks all that follows a word of reported speech in its clause."""
    def step(on, symbol):
        kind, marks = symbol
        on = on or kind == REPORT
        return on, (kind, marks | {"reported"}) if on and (kind in (INSULT, THREAT) or marks) else symbol
    return Transducer(False, step)


def _weigh() -> Transducer:
    """Emits the share of a word's weight that counts: threats need a target, negation and report take most away."""
    def step(state, symbol):
        kind, marks = symbol
        share = 1.0 if kind == INSULT else 0.3 if kind == THREAT else 0.5 if INSULT in marks else 0.6 if THREAT in marks else 0.0
        if "target" in marks:
            share *= 1.5 if kind == INSULT else 3.0
        if "negated" in marks:
            share *= 0.4
        if "reported" in marks:
            share *= 0.6
        return state, share
    return Transducer(0, step)


@lru_cache(maxsize=1)
def grammar() -> tuple[dict, tuple]:
    """The composed machine as a table (state, class) -> (state, share), all reachable states."""
    machine = _target().compose(_reach(NEGATION, "negated")).compose(_report()).compose(_weigh())
    table, todo = {}, [machine.start]
    while todo:
        s = todo.pop()
        for kind in (INSULT, THREAT, TARGET, NEGATION, REPORT, OTHER):
            if (s, kind) not in table:
                table[s, kind] = machine.step(s, (kind, frozenset()))
                todo.append(table[s, kind][0])
    return table, machine.start


_CLAUSE = re.compile(r"[.!?;:\n]+\s")
_WORD = re.compile(r"[^\W_]+(?:['’][^\W_]+)*")


@dataclass
class Model:
    stems: dict[str, float] = field(default_factory=dict)  # learnt: a stem, or a whole word with a final space
    fit: tuple[float, float, float] = (-3.0, 1.0, 1.0)  # intercept, log clause score, any match
    _lexicon: object = field(default=None, repr=False, compare=False)

    def __getstate__(self):
        return {"stems": self.stems, "fit": self.fit}

    def __setstate__(self, state):
        self.__dict__.update(state, _lexicon=None)

    def lexicon(self):
        """(automaton of insult and threat stems, class of each given whole word)."""
        if self._lexicon is None:
            auto = ahocorasick.Automaton()
            for kind in (INSULT, THREAT):
                for w in WORDS[kind].split():
                    auto.add_word(w, (w + " ", GIVEN_WEIGHT, kind))
            for s, weight in self.stems.items():
                auto.add_word(s.rstrip(" "), (s, weight, INSULT))
            auto.make_automaton()
            kinds = {w: kind for kind in (TARGET, NEGATION, REPORT) for w in WORDS[kind].split()}
            self._lexicon = auto, kinds
        return self._lexicon

    def matches(self, low: str) -> dict[int, tuple[float, str]]:
        """Start of each word that an insult or a threat stem opens -> (weight, class)."""
        auto, _ = self.lexicon()
        found: dict[int, tuple[float, str]] = {}
        for end, (stem, weight, kind) in auto.iter(low):
            at = end + 1 - len(stem.rstrip(" "))
            if at and low[at - 1].isalpha() or stem[-1] == " " and end + 1 < len(low) and low[end + 1].isalpha():
                continue
            if weight > found.get(at, (0.0, ""))[0]:
                found[at] = weight, kind
        return found

    def clauses(self, text: str) -> list[float]:
        """The score of each clause that holds an insult or a threat."""
        low = text.lower()
        found = self.matches(low)
        if not found:
            return []
        _, kinds = self.lexicon()
        table, start = grammar()
        out, begin, at = [], 0, sorted(found)
        k = 0
        for m in [*_CLAUSE.finditer(low), None]:
            end = m.end() if m else len(low)
            if k < len(at) and at[k] < end:
                state, total = start, 0.0
                for word in _WORD.finditer(low, begin, end):
                    hit = found.get(word.start())
                    kind = hit[1] if hit else kinds.get(word.group(), OTHER)
                    state, share = table[state, kind]
                    total += share * (hit[0] if hit else GIVEN_WEIGHT)
                while k < len(at) and at[k] < end:
                    k += 1
                out.append(total)
            begin = end
        return out

    def features(self, text: str) -> tuple[float, float, float]:
        total = sum(self.clauses(text))
        return 1.0, float(np.log1p(total)), float(total > 0)

    def scores(self, texts: list[str]) -> np.ndarray:
        x = np.array([self.features(t) for t in texts], dtype=float).reshape(-1, 3)
        return sigmoid(x @ np.array(self.fit))


def _stems(text: str) -> set[str]:
    """Every stem of the text's words, and the words with a final space."""
    out = set()
    for w in set(_WORD.findall(text.lower())):
        if len(w) >= LENGTHS[0]:
            out.add(w + " ")
            out.update(w[:n] for n in LENGTHS if n <= len(w))
    return out


def choose(counts: list[tuple[str, int, int]], held: list[set[str]], zero: int, one: int) -> dict[str, float]:
    """Stems that toxic rows hold and others don't, until every toxic row that can be is covered twice.

    ``counts``: (stem, toxic rows, other rows); ``held``: the stems among them of each toxic row.
    """
    weight = {}
    for stem, p, n in counts:
        odds = (p + 0.5) / (one + 1) / ((n + 0.5) / (zero + 1))
        if odds >= 20:
            weight[stem] = float(min(np.log(odds), 8.0))
    need = [2] * len(held)
    rows: dict[str, list[int]] = {}
    for i, stems in enumerate(held):
        for s in stems:
            if s in weight:
                rows.setdefault(s, []).append(i)
    out: dict[str, float] = {}
    gain = {s: len(r) for s, r in rows.items()}
    least = max(3, len(held) // 400)
    order = sorted(rows, key=lambda s: (-gain[s], len(s), s))
    while order:
        best, best_gain = None, least - 1
        for s in order:  # lazily, in falling order of the last known gain
            if gain[s] <= best_gain:
                break
            gain[s] = sum(need[i] > 0 for i in rows[s])
            if gain[s] > best_gain or gain[s] == best_gain and best is not None and (len(s), s) < (len(best), best):
                best, best_gain = s, gain[s]
        if best is None:
            break
        out[best] = weight[best]
        for i in rows[best]:
            need[i] -= 1
        order = sorted((s for s in order if s != best and not s.startswith(best)), key=lambda s: (-gain[s], len(s), s))
    return out


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", per_class: int = PER_CLASS) -> Model:
    """Learn stems and the logistic map from at most ``per_class`` labelled rows of each class that are not held out."""
    rows, (zero, one) = sample(docs, labels, label, per_class)
    if not zero or not one:
        return Model()
    small_batches(docs.sparkSession)
    size = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(size) < 2:
        return Model()

    def stems(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in slices(b):
                got: dict[str, list[int]] = {}
                for t, y in zip(part.column("text").to_pylist(), part.column("label").to_pylist()):
                    for s in _stems(t):
                        got.setdefault(s, [0, 0])[y] += 1
                yield pa.RecordBatch.from_arrays([pa.array(list(got)), pa.array([c[1] for c in got.values()], pa.int64()),
                                                  pa.array([c[0] for c in got.values()], pa.int64())], names=["stem", "p", "n"])

    ratio = size[0] / size[1]
    counts = rows.mapInArrow(stems, "stem string, p long, n long").groupBy("stem").agg(F.sum("p").alias("p"), F.sum("n").alias("n"))
    counts = counts.filter((F.col("p") >= 3) & (F.col("p") * ratio >= 9 * F.col("n")))
    top = [(r.stem, r.p, r.n) for r in counts.orderBy(F.desc("p"), F.length("stem"), "stem").limit(MOST_STEMS).collect()]
    tried = frozenset(s for s, _, _ in top)

    def hold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([sorted(_stems(t) & tried) for t in b.column("text").to_pylist()], pa.list_(pa.string()))],
                                             names=["stems"])

    held = rows.filter("label = 1").select("text").mapInArrow(hold, "stems array<string>").collect()  # at most per_class rows
    model = Model(choose(top, [set(r.stems) for r in held], size[0], size[1]))

    def feature(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.array([model.features(t) for t in b.column("text").to_pylist()], dtype=float).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays([pa.array(x[:, 1]), pa.array(x[:, 2]), b.column("label")], names=["a", "b", "label"])

    got = rows.select("text", "label").mapInArrow(feature, "a double, b double, label int").groupBy("a", "b", "label").agg(
        F.count(F.lit(1)).alias("n")).collect()  # at most 2 * per_class rows
    x = np.array([(1.0, r.a, r.b) for r in got])
    y = np.array([r.label for r in got], dtype=float)
    prior = np.where(y == 1, one / size[1], zero / size[0]) * np.array([r.n for r in got], dtype=float)
    order = np.lexsort((y, x[:, 2], x[:, 1]))
    a, b, c = logistic(x[order], y[order], prior[order], ridge=0.1)
    model.fit = float(a), float(max(b, 0.0)), float(max(c, 0.0))
    return model


def score(docs: DataFrame, model: Model, out: str = "score", text: str = "text") -> DataFrame:
    """``docs`` with each whole text's score (0 to 1, higher: label 1 likelier)."""
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)  # at most MOST_STEMS stems
    kept = [f for f in docs.schema if f.name != out]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            scores = m.scores([t or "" for t in b.column(text).to_pylist()])
            yield pa.RecordBatch.from_arrays([*(b.column(f.name) for f in kept), pa.array(scores)], names=[*(f.name for f in kept), out])

    return docs.mapInArrow(run, f"{schema}, `{out}` double")


def drop_toxic(docs: DataFrame, model: Model, least: float = 0.3) -> DataFrame:
    """The rows of ``docs`` whose score stays below ``least``."""
    return score(docs, model, "__score").filter(F.col("__score") < least).drop("__score")
