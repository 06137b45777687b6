"""Toxicity by a weighted finite-state pattern grammar.

Three transducers are composed over the words of a clause: the lexicon maps words to
weighted classes (insult, threat, target, negation, report), the scope transducer marks
what stands under a negation or in reported speech, and the pattern transducer accepts
sequences (an insult, an insult with a target, a threat with a target, a violent word)
and emits weighted matches. A document's score is a logistic function of its matched
clauses, not of isolated words.

The lexicon's fixed words are few; its weighted entries (words, and stems that take any
ending) are learned from a bounded sample of labelled training documents: an entry must
be tied to the toxic label beyond chance among all entries tried. Copies and near copies
in that sample (a verified Jaccard similarity of their words of 0.8) count once. Scoring is one pass
over whole texts without a shuffle: one compiled expression finds the clauses that hold
an entry, and only those are parsed.

Defined cases: null and empty texts have no match and get the model's base score;
repeated rows are scored each; null labels and labels of unknown documents are ignored;
without labels the fixed lexicon alone scores; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_sample_ids, fold_of, read_table, written

MOST_LABELLED = 12_000
MOST_ENTRIES = 2000
SHORTEST_STEM = 4
HELD_OUT_FOLD = 0
THRESHOLD = 0.5
COPY_SIMILARITY = 0.8            # of the word sets of near copies
BANDS, BAND_ROWS = 16, 4         # 0.9998 of the pairs at that similarity share a band
_MULTIPLIERS = (np.random.default_rng(5).integers(1, 1 << 62, BANDS * BAND_ROWS, np.uint64)
                * np.uint64(2) + np.uint64(1))

# fixed word lists of the grammar
TARGETS = ("you your yours u ur he him she her they them their people everyone "
           "du dich dir ihr euch er sie tu te toi vous il elle ils tú te usted ustedes él ella")
NEGATIONS = "not no never nobody don't isn't aren't nicht kein keine nie pas jamais nunca ni"
REPORTS = ("said says say wrote writes claimed claims called calls reported quoted allegedly "
           "sagte schrieb dit écrit dijo escribió")
THREATS = ("kill hurt destroy murder shoot stab beat punch burn hang strangle "
           "töten umbringen tuer frapper matar golpear")
WORD = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?")
CLAUSE_ENDS = ".!?;:\n"
CLAUSE_END = re.compile(f"[{CLAUSE_ENDS}]")

TARGET, NEGATION, REPORT, THREAT, INSULT, OTHER = range(6)
KINDS = ["insult", "directed", "threat", "violent"]
MODES = ["plain", "negated", "reported"]
FEATURES = [f"{k}_{m}" for k in KINDS for m in MODES] + ["weight", "strongest", "clauses"]


@dataclass
class Lexicon:
    """First transducer: word -> (class, weight)."""
    words: dict[str, float] = field(default_factory=dict)     # insults, whole words
    stems: dict[str, float] = field(default_factory=dict)     # insults, any ending

    def __post_init__(self):
        self.fixed = {}
        for cls, text in ((TARGET, TARGETS), (NEGATION, NEGATIONS), (REPORT, REPORTS),
                          (THREAT, THREATS)):
            self.fixed |= {w: (cls, 1.0) for w in text.split()}
        self.lengths = sorted({len(s) for s in self.stems})

    def classify(self, word: str) -> tuple[int, float]:
        if word in self.words:
            return INSULT, self.words[word]
        for n in self.lengths:
            if word[:n] in self.stems:
                return INSULT, self.stems[word[:n]]
        return self.fixed.get(word, (OTHER, 0.0))

    def triggers(self) -> re.Pattern:
        """Matches the words that can begin a match: insults and threats."""
        whole = sorted({*self.words, *THREATS.split()})
        parts = [re.escape(w) + r"(?!\w)" for w in whole]
        parts += [re.escape(s) for s in sorted(self.stems)]
        return re.compile(r"(?<!\w)(?:" + "|".join(parts) + ")")


def scoped(classes: list[tuple[int, float]]) -> Iterator[tuple[int, float, int]]:
    """Second transducer: adds the mode. A negation holds for the next three words, a
    report for the rest of the clause."""
    negated, mode = 0, 0
    for cls, weight in classes:
        if cls == NEGATION:
            negated = 4
        if cls == REPORT:
            mode = 2
        negated = max(0, negated - 1)
        yield cls, weight, mode or (1 if negated else 0)


# third transducer: (state, class) -> (state, kind emitted, weight factor). States: 0
# start, 1 a target was seen, 2 an insult is open, 3 a threat is open. An open item is
# emitted when its target follows, or when the clause ends.
ARCS = {
    (0, TARGET): (1, None, 0.0), (0, INSULT): (2, None, 0.0), (0, THREAT): (3, None, 0.0),
    (1, TARGET): (1, None, 0.0), (1, INSULT): (1, "directed", 1.5), (1, THREAT): (3, None, 0.0),
    (2, TARGET): (1, "directed", 1.5), (2, INSULT): (2, "insult", 1.0),
    (2, THREAT): (3, "insult", 1.0),
    (3, TARGET): (1, "threat", 1.5), (3, INSULT): (2, "violent", 0.3),
    (3, THREAT): (3, "violent", 0.3),
}
FINAL = {2: ("insult", 1.0), 3: ("violent", 0.3)}


def matches(classes: list[tuple[int, float]]) -> list[tuple[str, int, float]]:
    """(kind, mode, weight) of each match in a clause: the composed transducers."""
    out, state, held = [], 0, (0.0, 0)
    for cls, weight, mode in scoped(classes):
        if (state, cls) not in ARCS:
            continue
        to, kind, factor = ARCS[state, cls]
        if kind:
            w, m = held if state in (2, 3) else (weight, mode)
            out.append((kind, m, w * factor))
        if to in (2, 3):
            held = (weight, mode)
        state = to
    if state in FINAL:
        kind, factor = FINAL[state]
        out.append((kind, held[1], held[0] * factor))
    return out


def clauses(text: str, triggers: re.Pattern) -> Iterator[str]:
    """The clauses of a lower-case text that hold a trigger, each once."""
    end = 0
    for hit in triggers.finditer(text):
        if hit.start() < end:
            continue
        # the stretches searched do not overlap, so this stays linear
        begin = max(end, *(text.rfind(x, end, hit.start()) + 1 for x in CLAUSE_ENDS))
        found = CLAUSE_END.search(text, hit.end())
        end = found.start() if found else len(text)
        yield text[begin:end]


def features(text: str | None, lexicon: Lexicon, triggers: re.Pattern) -> list[float]:
    counts = dict.fromkeys(FEATURES, 0.0)
    for clause in clauses((text or "").lower(), triggers):
        counts["clauses"] += 1.0
        for kind, mode, weight in matches([lexicon.classify(w) for w in WORD.findall(clause)]):
            counts[f"{kind}_{MODES[mode]}"] += 1.0
            counts["weight"] += weight
            counts["strongest"] = max(counts["strongest"], weight)
    return [np.log1p(v) if k != "strongest" else v for k, v in counts.items()]


class Grammar:
    """Lexicon plus the logistic weights of the matched clauses."""

    def __init__(self, lexicon: Lexicon):
        self.lexicon, self.triggers = lexicon, lexicon.triggers()
        self.w = np.array([1.0] * len(FEATURES) + [-2.0])

    def __getstate__(self):
        return {"lexicon": self.lexicon, "w": self.w}

    def __setstate__(self, state):
        self.lexicon, self.w = state["lexicon"], state["w"]
        self.triggers = self.lexicon.triggers()

    def features(self, texts) -> np.ndarray:
        return np.array([features(t, self.lexicon, self.triggers) for t in texts]
                        ).reshape(-1, len(FEATURES))

    def fit(self, x: np.ndarray, y: np.ndarray, decay: float = 1e-3, steps: int = 400) -> None:
        """Logistic weights by Newton-like descent; skipped without both labels."""
        if not len(y) or y.min() == y.max():
            return
        x = np.hstack([x, np.ones((len(x), 1))])
        w = np.zeros(x.shape[1])
        ridge = decay * len(y) * np.eye(len(w))
        ridge[-1, -1] = 1e-6
        for _ in range(steps):
            p = 0.5 * (1 + np.tanh(0.5 * (x @ w)))
            g = x.T @ (p - y) + ridge @ w
            h = (x * (p * (1 - p))[:, None]).T @ x + ridge + 1e-6 * np.eye(len(w))
            step = np.linalg.solve(h, g)
            w -= step
            if np.abs(step).max() < 1e-6:
                break
        self.w = w

    def score(self, x: np.ndarray) -> np.ndarray:
        return 0.5 * (1 + np.tanh(0.5 * (x @ self.w[:-1] + self.w[-1])))


def distinct_words(docs: DataFrame) -> DataFrame:
    """(doc_id, words, bands): a document's distinct words, and codes of the bands of its
    min-wise sketch, by which near copies meet."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import zlib

        def bands(words: list[str]) -> list[int]:
            h = np.array([zlib.crc32(w.encode()) for w in words], np.uint64)
            if not len(h):
                return [0]
            least = ((h[:, None] + np.uint64(1)) * _MULTIPLIERS >> np.uint64(20)).min(axis=0)
            return [hash(tuple(x)) for x in least.reshape(BANDS, -1).tolist()]
        for b in batches:
            words = [sorted(set(WORD.findall((t or "").lower()))) for t in b["text"]]
            yield pd.DataFrame({"doc_id": b["doc_id"].astype("Int64"), "words": words,
                                "bands": [bands(ws) for ws in words]})
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInPandas(
        run, "doc_id long, words array<string>, bands array<long>")


def without_copies(sample: DataFrame) -> DataFrame:
    """The rows of (doc_id, toxic, words, bands) that are no near copy of a row of the same
    label with a smaller id. Every row is held against the smallest id of each of its
    bands only, so a group of copies makes no pairs."""
    key = ["toxic", "band", "code"]
    banded = sample.select("doc_id", "toxic", F.posexplode("bands").alias("band", "code"))
    first = banded.groupBy(*key).agg(F.min("doc_id").alias("first"))
    met = (banded.join(first, key).where("first < doc_id")
           .select("doc_id", "toxic", "first").distinct())
    shared, either = F.array_intersect("words", "others"), F.array_union("words", "others")
    copies = (met.join(sample.select("doc_id", "toxic", "words"), ["doc_id", "toxic"])
              .join(sample.select(F.col("doc_id").alias("first"), "toxic",
                                  F.col("words").alias("others")), ["first", "toxic"])
              .where(F.size(shared) >= COPY_SIMILARITY * F.size(either)))
    return sample.join(copies.select("doc_id").distinct(), "doc_id", "left_anti")


def learn_lexicon(sample: DataFrame) -> Lexicon:
    """Entries from (toxic, words) rows: words and stems whose documents are toxic far
    beyond the sample's share. The bound is chance among all candidates (Bonferroni),
    so only entries that would not arise by luck stay."""
    words = (sample.select("toxic", F.explode("words").alias("word"))
             .groupBy("word").agg(F.sum("toxic").alias("t"), F.count("*").alias("n")))
    words = written(words, "toxicity-words")
    stems = (words.select("t", "n", "word", F.explode(F.sequence(
        F.lit(SHORTEST_STEM), F.greatest(F.length("word"), F.lit(SHORTEST_STEM)))).alias("k"))
        .where(F.length("word") >= F.col("k"))
        .groupBy(F.expr("substring(word, 1, k)").alias("stem"))
        .agg(F.sum("t").alias("t"), F.sum("n").alias("n"), F.count("*").alias("kinds"),
             F.max(F.struct(F.length("word"), "word")).alias("m")))
    total = words.agg(F.sum("t").alias("t"), F.sum("n").alias("n"), F.count("*").alias("c")).first()
    if not total.n or not total.t or total.t == total.n:
        return Lexicon()
    share = total.t / total.n
    x, rest = F.col("t") / F.col("n"), F.col("n") - F.col("t")
    evidence = F.col("t") * F.log(x / F.lit(share)) + F.when(
        rest > 0, rest * F.log((F.lit(1.0) - x) / F.lit(1.0 - share))).otherwise(0.0)
    rows = (stems.where((F.col("t") >= 3) & (x > 0.8) & (x > 3.0 * share)
                        & (evidence > float(np.log(total.c) + 3.0)))
            .withColumn("weight", F.log((F.col("t") + 0.5) / (rest + 0.5) * (1 - share) / share))
            .orderBy(F.desc(evidence), "stem").limit(MOST_ENTRIES).collect())
    found = {r.stem: r for r in rows}
    lexicon, taken = Lexicon(), set()
    # the best of nested stems: neither its beginnings nor its endings are entries too
    for stem, r in found.items():
        if any(stem.startswith(t) or t.startswith(stem) for t in taken):
            continue
        taken.add(stem)
        # the longest entry with the same documents: a whole word stays a whole word
        longest = max((s for s in found if s.startswith(stem)
                       and (found[s].t, found[s].n) == (r.t, r.n)), key=len)
        if found[longest].kinds == 1 and found[longest].m.word == longest:
            lexicon.words[longest] = r.weight
        else:
            lexicon.stems[longest] = r.weight
    return Lexicon(lexicon.words, lexicon.stems)


def train(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELLED) -> Grammar:
    """Lexicon and clause weights from at most ``most`` labelled training documents."""
    usable = (labels.where(F.col("toxic").isin(0, 1) & (fold_of("doc_id") != HELD_OUT_FOLD))
              .select(F.col("doc_id").cast("bigint").alias("doc_id"), "toxic"))
    ids = bounded_sample_ids(usable.select("doc_id"), most, 5)
    if not ids:
        return Grammar(Lexicon())
    chosen = usable.where(F.col("doc_id").isin(ids)).dropDuplicates(["doc_id"])
    texts = docs.where(F.col("doc_id").isin(ids)).dropDuplicates(["doc_id"])
    labelled = written(distinct_words(texts).join(chosen, "doc_id"), "toxicity-labelled")
    sample = written(without_copies(labelled), "toxicity-sample")
    grammar = Grammar(learn_lexicon(sample))
    label = {r.doc_id: r.toxic for r in sample.select("doc_id", "toxic").collect()}
    seen = parsed(docs.where(F.col("doc_id").isin(sorted(label))), grammar).collect()
    seen = [r for r in seen if r.doc_id in label]
    grammar.fit(np.array([r.x for r in seen]).reshape(-1, len(FEATURES)),
                np.array([float(label[r.doc_id]) for r in seen]))
    return grammar


def parsed(docs: DataFrame, grammar: Grammar) -> DataFrame:
    """(doc_id, x): the clause features of every row."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"doc_id": b["doc_id"].astype("Int64"),
                                "x": list(grammar.features(b["text"]))})
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInPandas(
        run, "doc_id long, x array<double>")


def scored(docs: DataFrame, grammar: Grammar) -> DataFrame:
    """(doc_id, score, n_clauses) of every row."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            x = grammar.features(b["text"])
            yield pd.DataFrame({"doc_id": b["doc_id"].astype("Int64"), "score": grammar.score(x),
                                "n_clauses": np.rint(np.expm1(x[:, -1])).astype(np.int64)})
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInPandas(
        run, "doc_id long, score double, n_clauses long")


def op5_toxicity_grammar(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    return scored(docs, train(docs, labels)).select(
        "doc_id", (fold_of("doc_id") == HELD_OUT_FOLD).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "n_clauses")
