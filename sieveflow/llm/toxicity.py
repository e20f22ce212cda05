"""Toxicity by a lexicon under Levenshtein automata, weighed by context.

1. **Lexicon.** Words and word beginnings of the labelled training texts are counted by label in
   Spark; those found nearly only in toxic texts become terms (whole words, or beginnings such as
   a stem with many endings). What counts is in how many different contexts a text means a word, not
   quotes it; so neither copies nor the size of the input move the thresholds. Only if there were more than
   `MAX_TERMS`, which executors could not hold, does a term need more contexts; `min_contexts` of the result says how many.
   Of the texts, only those that may be labelled (by a bit filter of fixed size) are joined with their labels.
2. **Matching.** The terms form a trie. It is intersected with the automaton that accepts words within one edit, and the product
   is made deterministic as it is walked: a state is a set of (trie node, edits used). Words
   leave it after a few characters unless they resemble a term, so misspellings and letters swapped for
   digits are found in one pass without comparing each word with each term.
3. **Context.** A match counts less where a window around it shows quotation (inside quotation marks, or after a
   word of reporting), and more when it stands close to another match or to an address ("you").
4. **Score.** A logistic model of the weighted matches, their density and spread is fitted on at most `MAX_FIT`
   labelled training rows.

Whole texts are read; a text without words or matches gets the model's score for no match.

Defined results: a NULL text counts as empty. NULL ids have a NULL remainder: they are never
training rows and are not held out. Labels that are NULL, and all but one label of an id that is
labelled more than once (the larger), are not used. Without labels, or with one class only, the
lexicon is empty and every score is the prior. Repeated rows are scored alike. An empty table
gives an empty table; other columns are ignored by ``scores`` and kept by ``drop_toxic``.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from .common import Scratch, first_by_hash, may_hold, small_batches

MAX_TERMS = 50_000     # what executors can hold; beyond it a term needs more contexts
SLOTS = 1 << 18
REMEMBERED = 1 << 19
MAX_FIT = 20_000
MIN_CONTEXTS = 5       # different words that a term must follow in as many toxic training texts, at every size
MIN_PRECISION = 0.95   # of its contexts that are toxic
STEM = (4, 5, 6)       # lengths of word beginnings that may become terms
FUZZY_FROM = 5         # shorter terms have too many innocent neighbours
WINDOW = 6             # words on either side
THRESHOLD = 0.7
N_FEATURES = 5

# fixed values: quotation marks, words that report speech, words of address
OPENING = "\"“„«‹‘"
CLOSING = "\"”“»›’"
REPORTING = frozenset("said says quoted quote wrote called writes sagte schrieb zitat dit écrit cita dijo escribió".split())
ADDRESS = frozenset("you your u du dich dein sie ihr tu toi ton vous votre tú usted vosotros".split())
EDGES = " \t\n\r\v\f.,;:!?()[]{}<>*_-–—/\\|#%&=+~^`'" + OPENING + CLOSING


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string")) % 3 == 1


BARE = re.compile(r"^[\W_]+|[\W_]+$")


def meant_words(text: str) -> dict[str, str]:
    """Each word of a text, bare, with the one before its first place outside a quotation."""
    raw = text.lower().split()
    # only behind an opening mark or a word of reporting can a word be quoted
    doubtful = {j for i, w in enumerate(raw) if w[0] in OPENING or w.strip(EDGES) in REPORTING for j in range(i, i + WINDOW + 1)}
    found: dict[str, str] = {}
    last = ""
    for i, w in enumerate(raw):
        bare = w if w.isalnum() else BARE.sub("", w)
        if not bare:
            continue
        if bare not in found and not (i in doubtful and Scorer._is_quoted(raw[max(0, i - WINDOW): i], raw[i: i + WINDOW])):
            found[bare] = last
        last = bare
    return found


def _contexts(texts: DataFrame) -> DataFrame:
    """(w, before), once each: words that some of the `texts` means and a hash of the word before; copies add nothing."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import xxhash
        for b in batches:
            rows = {pair for t in b["text"] for pair in meant_words(t).items()}
            yield pd.DataFrame([(w, xxhash.xxh3_64_intdigest(x) - (1 << 63)) for w, x in rows], columns=["w", "before"])

    return small_batches(texts).select("text").mapInPandas(run, "w string, before long").distinct()


def _slot(term: str) -> int:
    import zlib
    return zlib.crc32(term.encode()) % SLOTS


def _needed(terms: DataFrame) -> np.ndarray:
    """By slot: how many clean contexts rule out the term of most toxic contexts in it (0 for no term). Fixed size."""
    needed = np.zeros(SLOTS, dtype=np.int64)
    most = terms.groupBy((F.crc32("term") % SLOTS).alias("slot")).agg(F.max("bad").alias("bad")).collect()
    for r in most:
        needed[r.slot] = math.floor(r.bad / MIN_PRECISION - r.bad) + 1
    return needed


def _clean_contexts(texts: DataFrame, words: DataFrame, stems: DataFrame) -> DataFrame:
    """(w, clean): in how many contexts the clean `texts` mean a word, as far as that can matter.

    Only words that are candidates or begin with one count, and once a task has seen as many contexts of a word as rule out
    its term, more of them change nothing.
    """
    of_word, of_stem = _needed(words), _needed(stems)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import xxhash
        seen: dict[str, set[int]] = {}
        need: dict[str, int] = {}
        for b in batches:
            out = []
            for t in b["text"]:
                for w, before in meant_words(t).items():
                    n = need.get(w)
                    if n is None:
                        n = need[w] = int(max(of_word[_slot(w)], *(of_stem[_slot(w[:k])] for k in STEM if len(w) >= k), 0))
                    if n:
                        known = seen.setdefault(w, set())
                        if len(known) < n and (x := xxhash.xxh3_64_intdigest(before) - (1 << 63)) not in known:
                            known.add(x)
                            out.append((w, x))
            if len(need) > REMEMBERED:  # forgetting costs repeated rows, which are made distinct below
                need.clear()
                seen.clear()
            yield pd.DataFrame(out, columns=["w", "before"])

    return small_batches(texts).select("text").mapInPandas(run, "w string, before long").distinct().groupBy("w").agg(F.count("*").alias("clean"))


def _beginnings(words: DataFrame) -> DataFrame:
    """`words` once for each of their beginnings of `STEM` characters, as term."""
    return words.select("*", F.explode(F.array_distinct(F.array(*(F.substring("w", 1, k) for k in STEM)))).alias("term")).where(
        F.length("term") >= min(STEM))


def lexicon(texts: DataFrame, scratch: Scratch | None = None) -> list[tuple[str, bool, int]]:
    """(term, is a beginning, toxic contexts) from rows of (text, toxic)."""
    return lexicon_and_support(texts, scratch)[0]


def lexicon_and_support(texts: DataFrame, scratch: Scratch | None = None) -> tuple[list[tuple[str, bool, int]], int]:
    """The lexicon, and how many contexts its terms had to have.

    A text adds one context to each word that it means: the word before. Copies add the same one, so
    five contexts are five different texts, and precision is the toxic share of a word's contexts. Toxic texts, which are
    few, say which words can be terms; clean ones are asked about these only. If there are more than `MAX_TERMS`, the number of
    contexts that a term needs rises until there are not.
    """
    scratch = scratch or Scratch(texts.sparkSession, "lexicon")
    toxic = scratch.store(_contexts(texts.where("toxic = 1")).groupBy("w").agg(F.count("*").alias("bad")))
    words = toxic.where(F.col("bad") >= MIN_CONTEXTS).select(F.col("w").alias("term"), "bad")
    stems = _beginnings(toxic).groupBy("term").agg(F.sum("bad").alias("bad"), F.count("*").alias("kind")).where(
        (F.col("kind") >= 3) & (F.col("bad") >= MIN_CONTEXTS))
    clean = scratch.store(_clean_contexts(texts.where("toxic = 0"), words, stems))
    good = (F.col("bad") >= MIN_CONTEXTS) & (F.col("bad") >= MIN_PRECISION * (F.col("bad") + F.coalesce("clean", F.lit(0))))
    whole = words.join(clean.withColumnRenamed("w", "term"), "term", "left").where(good).select("term", F.lit(False).alias("stem"), "bad")
    under = _beginnings(clean).groupBy("term").agg(F.sum("clean").alias("clean"))
    begun = stems.join(under, "term", "left").where(good).select("term", F.lit(True).alias("stem"), "bad")
    found = scratch.store(whole.unionByName(begun))
    support = _support(found)
    rows = found.where(F.col("bad") >= support).select("term", "stem", F.col("bad").alias("contexts")).collect()  # at most MAX_TERMS
    rows = sorted(rows, key=lambda r: (-r.contexts, r.term, r.stem))
    stems = {r.term for r in rows if r.stem}
    # a stem that begins with a shorter one adds nothing to it; a whole word is also found misspelled
    return [(r.term, r.stem, r.contexts) for r in rows
            if not (r.stem and any(r.term[:k] in stems for k in STEM if k < len(r.term)))], support


def _support(found: DataFrame) -> int:
    """The least number of contexts, `MIN_CONTEXTS` or more, that at most `MAX_TERMS` terms have."""
    grade = F.least(F.col("bad"), F.floor(F.log2("bad") * 64) + 1024)  # exact for small numbers, as few grades as bits for large
    held = 0
    for r in found.groupBy(grade.alias("g")).agg(F.count("*").alias("n"), F.max("bad").alias("most")).orderBy(F.desc("most")).collect():
        held += r.n
        if held > MAX_TERMS:
            return r.most + 1
    return MIN_CONTEXTS


@dataclass
class Automaton:
    """Terms as a trie, met with the one-edit automaton; states are made when first reached."""

    terms: list[tuple[str, bool]]
    children: list[dict[str, int]] = field(default_factory=lambda: [{}])
    ends: dict[int, bool] = field(default_factory=dict)      # node -> whether the term is a stem
    fuzzy: set[int] = field(default_factory=set)             # nodes on the way to a term that may be misspelled
    whole: set[int] = field(default_factory=set)             # and where such a term ends
    states: list[dict[int, int]] = field(default_factory=list)
    numbers: dict[frozenset, int] = field(default_factory=dict)
    steps: list[dict[str, int]] = field(default_factory=list)
    accepts: list[int] = field(default_factory=list)         # edits of the best whole term, -1 for none
    stems: list[int] = field(default_factory=list)           # the same for a stem that ends here

    def __post_init__(self):
        for term, stem in self.terms:
            node, path = 0, [0]
            for c in term:
                node = self.children[node].setdefault(c, len(self.children))
                if node == len(self.children):
                    self.children.append({})
                path.append(node)
            self.ends[node] = stem or self.ends.get(node, False)
            if len(term) >= FUZZY_FROM and not stem:
                self.fuzzy.update(path)
                self.whole.add(node)
        self.alphabet = {c for d in self.children for c in d}
        self._number({0: 0})

    def _number(self, edits: dict[int, int]) -> int:
        # a term's letter may be left out without reading anything
        for node, e in list(edits.items()):
            if e == 0:
                for child in self.children[node].values():
                    if child in self.fuzzy:
                        edits[child] = min(edits.get(child, 1), 1)
        key = frozenset(edits.items())
        if key not in self.numbers:
            self.numbers[key] = len(self.states)
            self.states.append(edits)
            self.steps.append({})
            ends = [(e, self.ends[n]) for n, e in edits.items() if n in self.ends and (e == 0 or n in self.whole)]
            self.accepts.append(min((e for e, _ in ends), default=-1))
            self.stems.append(min((e for e, stem in ends if stem and e == 0), default=-1))
        return self.numbers[key]

    def _step(self, state: int, c: str) -> int:
        reached: dict[int, int] = {}
        for node, e in self.states[state].items():
            if (child := self.children[node].get(c)) is not None:
                reached[child] = min(reached.get(child, e), e)
            if e == 0 and node in self.fuzzy:
                reached[node] = min(reached.get(node, 1), 1)
                for child in self.children[node].values():
                    if child in self.fuzzy:
                        reached[child] = min(reached.get(child, 1), 1)
        number = self._number(reached) if reached else -1
        self.steps[state][c] = number
        return number

    def match(self, word: str) -> int:
        """0 for a term as it is, 1 for one with an edit, -1 for none."""
        state = 0
        for c in word:
            c = c if c in self.alphabet else "\0"
            nxt = self.steps[state].get(c)
            state = self._step(state, c) if nxt is None else nxt
            if state < 0:
                return -1
            if self.stems[state] >= 0:
                return self.stems[state]
        return self.accepts[state]


class Scorer:
    """Features of a text; keeps what it learned about words between texts of a task."""

    REMEMBERED = 1 << 17

    def __init__(self, terms: list[tuple[str, bool]]):
        self.automaton, self.known = Automaton(terms), {}

    def strength(self, word: str) -> float:
        """1 for a term, less for a misspelled one, 0 for none."""
        edits = self.automaton.match(word.strip(EDGES))
        value = (0.0 if edits < 0 else 1.0 if edits == 0 else 0.6)
        if len(self.known) >= self.REMEMBERED:
            self.known.clear()
        self.known[word] = value
        return value

    def features(self, text: str) -> tuple[float, ...]:
        words = text.lower().split()
        known, strength = self.known, self.strength
        hits = [(i, s) for i, w in enumerate(words) if (s := known[w] if w in known else strength(w))]
        if not hits:
            return (0.0,) * N_FEATURES
        meant = quoted = near = 0.0
        last = -10 * WINDOW
        for i, s in hits:
            before, after = words[max(0, i - WINDOW): i], words[i: i + WINDOW]
            if self._is_quoted(before, after):
                quoted += s
            else:
                meant += s
                near += s * (i - last <= WINDOW or any(w.strip(EDGES) in ADDRESS for w in before + after))
            last = i
        return (float(meant > 0), math.log1p(meant), math.log1p(quoted), math.log1p(near), math.log1p(100 * meant / len(words)))

    @staticmethod
    def _is_quoted(before: list[str], after: list[str]) -> bool:
        """A quotation opens in the window before and closes in the one after, or speech is reported."""
        depth = 0
        for w in before + after[:1]:
            depth = 1 if w[0] in OPENING else 0 if w[-1] in CLOSING and w is not after[0] else depth
        closes = any(w.rstrip(".,;:!?")[-1:] in CLOSING and w.rstrip(".,;:!?")[-1:] for w in after)
        return bool(depth and closes) or any(w.strip(EDGES) in REPORTING for w in before[-2:])


def _logistic(x: np.ndarray, y: np.ndarray, prior: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Newton steps towards the weights, drawn to `prior` where the data say nothing.

    A whole step can overshoot where labels part cleanly, so it is halved until the loss falls.
    """
    def loss(w: np.ndarray) -> float:
        z = x @ w
        return float(np.sum(np.logaddexp(0, z) - y * z) + ridge / 2 * np.sum((w - prior) ** 2))

    w, now = prior.copy(), loss(prior)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(hessian, x.T @ (y - p) - ridge * (w - prior))
        size = 1.0
        while size > 1e-6 and loss(w + size * step) > now:
            size /= 2
        w, before, now = w + size * step, now, loss(w + size * step)
        if before - now < 1e-9 * max(1.0, before):
            break
    return w


# intercept, any, meant, quoted, near, density: what holds before any label is seen
PRIOR = np.array([-3.0, 2.5, 1.5, 0.1, 0.5, 0.3])


@dataclass
class Model:
    terms: list[tuple[str, bool]]
    weights: np.ndarray
    min_contexts: int = MIN_CONTEXTS

    def score(self, features: np.ndarray) -> np.ndarray:
        x = np.column_stack((np.ones(len(features)), features))
        return 1 / (1 + np.exp(-np.clip(x @ self.weights, -30, 30)))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_id: str = "doc_id",
        label_col: str = "toxic", max_fit: int = MAX_FIT) -> Model:
    """Lexicon from all training rows, weights from at most `max_fit` of them (the first by a hash of their id)."""
    marks = labels.select(F.col(f"`{label_id}`").alias("k"), F.col(f"`{label_col}`").cast("int").alias("toxic")).where(
        "k IS NOT NULL AND toxic IS NOT NULL").where(~held_out(F.col("k"))).groupBy("k").agg(F.max("toxic").alias("toxic"))
    rows = small_batches(docs).select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    scratch = Scratch(docs.sparkSession, "toxicity")
    marks = scratch.store(marks)
    # the same kind of join at every size: labels grow with the documents
    training = scratch.store(rows.where(may_hold(marks, "k")(F.col("id"))).join(marks.hint("merge"), F.col("id") == F.col("k")).select("text", "toxic"))
    entries, support = lexicon_and_support(training, scratch)
    terms = [(t, stem) for t, stem, _ in entries]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(terms)
        for b in batches:
            f = np.array([scorer.features(t) for t in b["text"]], dtype=float).reshape(-1, N_FEATURES)
            yield pd.DataFrame({"id": b["id"].astype(str), "toxic": b["toxic"], **{f"f{i}": f[:, i] for i in range(N_FEATURES)}})

    schema = "id string, toxic int, " + ", ".join(f"f{i} double" for i in range(N_FEATURES))
    # at most `max_fit` ids, so their size is bounded whatever the number of labels
    chosen = first_by_hash(marks, "k", max_fit)
    drawn = rows.join(F.broadcast(chosen), F.col("id") == F.col("k")).select("id", "text", "toxic")
    sample = drawn.mapInPandas(run, schema).toPandas().sort_values("id")
    x = np.column_stack((np.ones(len(sample)), sample[[f"f{i}" for i in range(N_FEATURES)]].to_numpy(float)))
    y = sample["toxic"].to_numpy(float)
    return Model(terms, _logistic(x, y, PRIOR), support)


def scores(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
           threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted (1 from `threshold` on), min_contexts."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(model.terms)
        for b in batches:
            f = np.array([scorer.features(t or "") for t in b["text"]], dtype=float).reshape(-1, N_FEATURES)
            yield pd.DataFrame({"doc_id": b["doc_id"], "score": model.score(f)})

    scored = small_batches(docs).select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text")).mapInPandas(
        run, f"doc_id {id_type}, score double")
    return scored.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"), F.lit(model.min_contexts).alias("min_contexts"))


def drop_toxic(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of `docs`, all columns as they are, that score below `threshold`.

    Texts are scored as they stream past, so no join is needed to keep or drop a row.
    """
    schema = docs.schema

    def run(batches):
        import pyarrow as pa
        scorer = Scorer(model.terms)
        for b in batches:
            f = np.array([scorer.features(t or "") for t in b.column(text_col).to_pylist()], dtype=float).reshape(-1, N_FEATURES)
            yield b.filter(pa.array(model.score(f) < threshold))

    return small_batches(docs).mapInArrow(run, schema)
