"""Toxicity: Levenshtein automata intersected with a lexicon trie, and context-window scores.

The lexicon holds whole words and word beginnings that mark toxic training rows: their counts over
toxic and other rows are compared by a likelihood ratio, so it follows the data and its languages. A
word is read through the product of the trie of the lexicon and the Levenshtein automaton of each
entry; states that were reached once are kept, so reading on costs one lookup per letter. Entries of
five letters or more may be misspelled by one edit, of nine or more by two.

What misspellings are worth is looked up in the training rows: forms that many clean rows hold are
words of their own, and of the others each entry's hits with one and two edits are counted over toxic
and clean rows. Every hit is weighed by its entry, its edits and the window around it: other hits near by add to it,
quotation marks around it and words of reporting before it take from it. The sum of a text is turned
into a probability by a logistic curve fitted on at most ``SAMPLE_ROWS`` training rows of each class,
the one bound here; counts cover all training rows.

Defined cases: null and wordless texts have no hits. Labels that are null or not 0 or 1, or whose
document is missing, are ignored; a document labelled twice counts twice. Without labels of both
classes, or with an empty lexicon, every score is the share of toxic training rows (0 without any).
Rows that repeat keep their rows.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import compress, islice, takewhile

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from restock.llm.common import Places, is_held_out, likely, written

SAMPLE_ROWS = 3_000
SHORTEST, LONGEST = 4, 12
LEAST_RATIO = 20.0
LEAST_PRECISION = 0.75
# A misspelled form in this share of the clean training rows is a word of its own.
COMMON_FORM = 0.0005
WINDOW = 6
# Signs and words that tell a quotation or a report from abuse.
QUOTES = set("\"'“”„«»‘’‹›")
REPORTS = frozenset(
    "said says wrote quoted quote called reported sagte schrieb zitat nannte dijo escribió cita llamó dit écrit citation appelé".split()
)
_TOKEN = re.compile(r"\w+|[\"'“”„«»‘’‹›]")
_CACHE_WORDS = 400_000
# Hash places of terms of toxic rows: 2 MB in every task.
PLACES = 1 << 24
_WHOLE = "$"


def terms_of(word: str) -> Iterator[str]:
    """The word itself, closed by a sign, and its beginnings."""
    for size in range(SHORTEST, min(LONGEST, len(word)) + 1):
        yield word[:size]
    yield word + _WHOLE


def edits(term: str) -> int:
    """Edits an entry may be misspelled by."""
    size = len(term.rstrip(_WHOLE))
    return 0 if size < 5 else 1 if size < 9 else 2


def _words(text: str | None) -> list[str]:
    return _TOKEN.findall(text.lower()) if text else []


def _term_counts(wanted: Places | None):
    """Rows that hold each term, within a task; of all terms or of those at wanted places."""

    def chosen(word: str) -> tuple[str, ...]:
        terms = tuple(terms_of(word))
        if wanted is None:
            return terms
        codes = [xxhash.xxh64_intdigest(term.encode("utf-8", "surrogatepass"), 42) for term in terms]
        return tuple(compress(terms, wanted.hold(np.array(codes, np.uint64)).tolist()))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: Counter[str] = Counter()
        known: dict[str, tuple[str, ...]] = {}

        def rows() -> pd.DataFrame:
            return pd.DataFrame({"term": list(counts.keys()), "n": list(counts.values())})

        for batch in batches:
            for text in batch["text"]:
                held: set[str] = set()
                for word in set(_words(text)):
                    terms = known.get(word)
                    if terms is None:
                        if len(known) > _CACHE_WORDS:
                            known.clear()
                        terms = known[word] = chosen(word)
                    held.update(terms)
                counts.update(held)
            if len(counts) > 500_000:
                yield rows()
                counts.clear()
        if counts:
            yield rows()

    return count


def ratio(toxic: np.ndarray, clean: np.ndarray, n_toxic: float, n_clean: float) -> np.ndarray:
    """Likelihood ratio of a term's rows being spread unlike all rows."""
    both = toxic + clean
    expected = both * n_toxic / (n_toxic + n_clean), both * n_clean / (n_toxic + n_clean)
    with np.errstate(divide="ignore", invalid="ignore"):
        parts = [np.where(n > 0, n * np.log(n / e), 0.0) for n, e in zip((toxic, clean), expected, strict=True)]
    return 2 * (parts[0] + parts[1])


def chosen_terms(table: pd.DataFrame, n_toxic: int, n_clean: int) -> dict[str, float]:
    """Lexicon with weights from counts (term, toxic, clean); beginnings stand for what they begin."""
    toxic, clean = table["toxic"].to_numpy(float), table["clean"].to_numpy(float)
    share = toxic / np.maximum(toxic + clean, 1)
    fits = (ratio(toxic, clean, n_toxic, n_clean) >= LEAST_RATIO) & (share >= LEAST_PRECISION)
    weights = np.log(((toxic + 0.5) / (n_toxic + 1)) / ((clean + 0.5) / (n_clean + 1)))
    strength = dict(zip(table["term"][fits], zip(weights[fits], toxic[fits], strict=True), strict=True))
    kept: dict[str, float] = {}
    for term in sorted(strength, key=lambda t: (len(t), t)):
        body = term.rstrip(_WHOLE)
        shorter = (body[:size] for size in range(SHORTEST, len(body) + (term != body)))
        if not any(begin in kept and strength[term][1] <= strength[begin][1] for begin in shorter):
            kept[term] = float(strength[term][0])
    # Of beginnings that hold the same rows the longest says most, a whole word even more.
    ordered = sorted(strength)
    for term in list(kept):
        begun = takewhile(lambda t, term=term: t.startswith(term), islice(ordered, bisect_left(ordered, term), None))
        same = [t for t in begun if strength[t][1] == strength[term][1]]
        longest = max(same, key=lambda t: (len(t), t))
        kept[longest] = float(strength[longest][0])
        if longest != term:
            del kept[term]
    return kept


class Automaton:
    """The trie of all entries, read with up to two edits each.

    A state is a set of (trie node, row of the edit table); a step is worked out once per letter.
    """

    def __init__(self, lexicon: dict[str, float]):
        self.children: list[dict[str, int]] = [{}]
        self.depth = [0]
        self.entries: list[tuple[str, bool] | None] = [None]
        self.limit = [0]
        for term in sorted(lexicon):
            node, allowed = 0, edits(term)
            self.limit[0] = max(self.limit[0], allowed)
            for letter in term.rstrip(_WHOLE):
                if letter not in self.children[node]:
                    self.children[node][letter] = len(self.children)
                    self.children.append({})
                    self.depth.append(self.depth[node] + 1)
                    self.entries.append(None)
                    self.limit.append(0)
                node = self.children[node][letter]
                self.limit[node] = max(self.limit[node], allowed)
            if self.entries[node] is None or not term.endswith(_WHOLE):
                self.entries[node] = term, term.endswith(_WHOLE)
        self.starts = self._closed({0: 0})
        self.states: dict[tuple, int] = {self.starts: 0}
        self.sets: list[tuple] = [self.starts]
        self.steps: list[dict[str, int]] = [{}]
        self.found: list[tuple[int, str] | None] = [self._begun(self.starts)]
        self.words: dict[str, tuple[int, str] | None] = {}
        self.plain: frozenset[str] = frozenset()

    def _closed(self, errors: dict[int, int]) -> tuple:
        """Adds nodes reached by leaving letters out."""
        open_nodes = sorted(errors, key=self.depth.__getitem__)
        for node in open_nodes:
            for child in self.children[node].values():
                more = errors[node] + 1
                if more <= self.limit[child] and more < errors.get(child, 9):
                    if child not in errors:
                        open_nodes.append(child)
                    errors[child] = more
        return tuple(sorted(errors.items()))

    def _step(self, state: int, letter: str) -> int:
        errors: dict[int, int] = {}
        for node, done in self.sets[state]:
            if done + 1 <= self.limit[node]:  # a letter too many
                errors[node] = min(errors.get(node, 9), done + 1)
            for other, child in self.children[node].items():
                more = done + (other != letter)
                if more <= self.limit[child]:
                    errors[child] = min(errors.get(child, 9), more)
        key = self._closed(errors)
        number = self.states.get(key)
        if number is None:
            number = self.states[key] = len(self.sets)
            self.sets.append(key)
            self.steps.append({})
            self.found.append(self._begun(key))
        self.steps[state][letter] = number
        return number

    def _best(self, state: tuple, whole: bool) -> tuple[int, str] | None:
        hits = [
            (done, entry[0])
            for node, done in state
            if (entry := self.entries[node]) and entry[1] == whole and done <= edits(entry[0])
        ]
        return min(hits, default=None)

    def _begun(self, state: tuple) -> tuple[int, str] | None:
        return self._best(state, False)

    def match(self, word: str) -> tuple[int, str] | None:
        """(edits, entry) of the nearest entry that is the word or begins it."""
        if word in self.words:
            return self.words[word]
        if word in self.plain:
            return None
        if len(self.words) > _CACHE_WORDS:
            self.words.clear()
        state, begun = 0, None
        for letter in word:
            state = self.steps[state].get(letter) or self._step(state, letter)
            if not self.sets[state]:
                break
            here = self.found[state]
            if here is not None and (begun is None or here < begun):
                begun = here
        whole = self._best(self.sets[state], True)
        best = min((hit for hit in (begun, whole) if hit is not None), default=None)
        self.words[word] = best
        return best


@dataclass(frozen=True)
class Knowledge:
    """Entries with their weights, weights of misspelled hits where there is evidence, and forms that are no hits."""

    lexicon: dict[str, float]
    misspelled: dict[tuple[str, int], float] = field(default_factory=dict)
    plain: frozenset[str] = frozenset()

    def weight(self, entry: str, done: int) -> float:
        usual = self.lexicon[entry] * 0.5**done
        return min(usual, self.misspelled.get((entry, done), usual)) if done else usual


class Scorer:
    """Sum of weighed hits of a text."""

    def __init__(self, knowledge: Knowledge):
        self.knowledge = knowledge
        self.automaton = Automaton(knowledge.lexicon)
        self.automaton.plain = knowledge.plain

    def hits(self, text: str | None) -> tuple[list[str], list[tuple[int, int, str]]]:
        words = _words(text)
        match = self.automaton.match
        return words, [(at, *hit) for at, word in enumerate(words) if (hit := match(word)) is not None]

    def score(self, text: str | None) -> float:
        """Hits weigh more among other hits and less in a quotation or a report."""
        words, hits = self.hits(text)
        weighed = [(at, weight) for at, done, entry in hits if (weight := self.knowledge.weight(entry, done)) > 0]
        places = np.array([at for at, _ in weighed])
        total = 0.0
        for at, weight in weighed:
            near = int((np.abs(places - at) <= WINDOW).sum()) - 1
            before, after = words[max(0, at - WINDOW) : at], words[at + 1 : at + 1 + WINDOW]
            quoted = bool(QUOTES.intersection(before)) and bool(QUOTES.intersection(after))
            reported = bool(REPORTS.intersection(before))
            total += weight * (0.3 if quoted else 1.0) * (0.5 if reported else 1.0) * (1 + 0.25 * min(near, 4))
        return total


def _form_counts(lexicon: dict[str, float]):
    """Training rows that hold each misspelled form, by label, within a task."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        automaton = Automaton(lexicon)
        counts: Counter[tuple] = Counter()
        for batch in batches:
            for label, text in zip(batch["label"], batch["text"], strict=True):
                for word in set(_words(text)):
                    hit = automaton.match(word)
                    if hit is not None and hit[0]:
                        counts[word, hit[1], hit[0], label] += 1
        if counts:
            rows = [(*key, n) for key, n in counts.items()]
            yield pd.DataFrame(rows, columns=["form", "entry", "edits", "label", "n"])

    return count


def knowledge_of(training: DataFrame, n_toxic: int, n_clean: int) -> Knowledge:
    """Lexicon of the training rows and what its misspellings are worth.

    The driver receives the forms that a fixed share of the clean rows holds, and two counts for each
    entry and number of edits.
    """
    lexicon = lexicon_of(training, n_toxic, n_clean)
    if not lexicon:
        return Knowledge({})
    rows = training.select("label", "text").mapInPandas(
        _form_counts(lexicon), "form string, entry string, edits int, label int, n long"
    )
    forms = written(rows.groupBy("form", "entry", "edits", "label").agg(F.sum("n").alias("n")))
    common = forms.filter((F.col("label") == 0) & (F.col("n") >= max(2.0, COMMON_FORM * n_clean))).select("form")
    counted = forms.join(common, "form", "left_anti").groupBy("entry", "edits", "label").agg(F.sum("n").alias("n"))
    seen: dict[tuple[str, int], list[int]] = {}
    for row in counted.collect():
        seen.setdefault((row.entry, row.edits), [0, 0])[row.label] = row.n
    misspelled = {
        key: float(max(0.0, np.log((toxic + 0.5) / (n_toxic + 1) / ((clean + 0.5) / (n_clean + 1)))))
        for key, (clean, toxic) in seen.items()
    }
    return Knowledge(lexicon, misspelled, frozenset(row.form for row in common.collect()))


def logistic(sums: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and intercept of a curve over log(1 + sum), by Newton steps with a small penalty."""
    x = np.column_stack([np.log1p(sums), np.ones(len(sums))])
    beta = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-(x @ beta)))
        gradient = x.T @ (labels - p) - 1e-2 * beta
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        beta += step
        if np.abs(step).max() < 1e-8:
            break
    return float(beta[0]), float(beta[1])


def lexicon_of(training: DataFrame, n_toxic: int, n_clean: int) -> dict[str, float]:
    """Lexicon from rows (text, label): terms of toxic rows first, then the clean rows that hold them.

    A term needs enough toxic rows to pass the ratio even without a clean one, whatever the number of
    rows, and is then counted in the clean rows. Both counts stay in Spark; the driver receives the
    terms that pass ratio and precision.
    """
    if not n_toxic or not n_clean:
        return {}
    alone = 2 * np.log((n_toxic + n_clean) / n_toxic)
    least = max(2.0, LEAST_RATIO / alone)

    def counted(label: int, wanted: Places | None) -> DataFrame:
        rows = training.filter(F.col("label") == label).select("text")
        return rows.mapInPandas(_term_counts(wanted), "term string, n long").groupBy("term").agg(F.sum("n").alias("n"))

    toxic = written(counted(1, None).filter(F.col("n") >= least).withColumnRenamed("n", "toxic"))
    wanted = Places.of(toxic.select(F.xxhash64("term").alias("code")), "code", PLACES)
    clean = counted(0, wanted).withColumnRenamed("n", "clean")
    both = toxic.join(clean, "term", "left").fillna({"clean": 0})
    total = F.col("toxic") + F.col("clean")
    parts = [
        F.when(F.col(name) > 0, F.col(name) * F.log(F.col(name) * (n_toxic + n_clean) / (total * n))).otherwise(0.0)
        for name, n in (("toxic", n_toxic), ("clean", n_clean))
    ]
    # The last digits are decided by the same tests on the driver.
    likely_terms = (2 * (parts[0] + parts[1]) >= LEAST_RATIO - 1e-6) & (F.col("toxic") >= LEAST_PRECISION * total - 1e-6)
    return chosen_terms(both.filter(likely_terms).toPandas(), n_toxic, n_clean)


_scorers: dict[int, Scorer] = {}


def _scorer(knowledge: Knowledge) -> Scorer:
    key = hash((frozenset(knowledge.lexicon.items()), frozenset(knowledge.misspelled.items()), knowledge.plain))
    if key not in _scorers:
        _scorers.clear()
        _scorers[key] = Scorer(knowledge)
    return _scorers[key]


def scores(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "toxic",
    divisor: int = 5,
    rest: int = 0,
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted and ``hits`` (the weighed sum)."""
    usable = labels.filter(F.col(label).isin(0, 1)).select("doc_id", F.col(label).cast("int").alias("label"))
    open_rows = docs.filter(~is_held_out("doc_id", divisor, rest)).select("doc_id", "text")
    # One kind of join at every size: texts of labelled rows are shuffled whether or not there are few labels.
    joined = likely(open_rows, usable, "doc_id").join(usable.hint("merge"), "doc_id")
    training = written(joined.select("doc_id", "text", "label"))
    sizes = {row[0]: row[1] for row in training.groupBy("label").count().collect()}
    n_clean, n_toxic = sizes.get(0, 0), sizes.get(1, 0)
    knowledge = knowledge_of(training, n_toxic, n_clean)

    @F.pandas_udf("double")
    def summed(texts: pd.Series) -> pd.Series:
        scorer = _scorer(knowledge)
        return pd.Series([scorer.score(text) for text in texts], dtype="float64")

    if knowledge.lexicon:
        mixed = F.xxhash64(F.col("doc_id"), F.lit(11))
        sums, marks = [], []
        for mark in (0, 1):
            part = training.filter(F.col("label") == mark).orderBy(mixed).limit(sample_rows)
            found = part.select(summed("text")).toPandas().iloc[:, 0].tolist()
            sums += found
            marks += [mark] * len(found)
        slope, intercept = logistic(np.array(sums), np.array(marks, float))
    else:
        share = n_toxic / max(1, n_toxic + n_clean)
        slope, intercept = 0.0, float(np.log(share / (1 - share))) if 0 < share < 1 else (-40.0 if share < 1 else 40.0)
    score = 1 / (1 + F.exp(-(F.lit(slope) * F.log1p("hits") + F.lit(intercept))))
    rows = docs.select("doc_id", is_held_out("doc_id", divisor, rest).alias("held_out"), summed("text").alias("hits"))
    return rows.select(
        "doc_id", "held_out", score.alias("score"), (score >= 0.5).cast("int").alias("predicted"), "hits"
    )
