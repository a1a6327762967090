"""Quality rules: a decision list learned by sequential covering, in Spark expressions only."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.common import pick, positional, stored

BLANKS = " \t\n\x0b\x0c\r"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
BINS = 32                 # thresholds tried per feature (quantiles of the labelled rows)
MAX_RULES = 8
MAX_CONDITIONS = 3
MIN_PRECISION = 0.9       # of a rule on the pruning rows, else the list ends
MIN_COVER = 5             # rejected rows that a rule has to cover on the growing rows


# ------------------------------------------------------------------ statistics
def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once (bound as a lambda's variable)."""
    return F.transform(F.array(value), body)[0]


def _words(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(BLANKS))
    return F.when(F.length(trimmed) == 0, F.array().cast("array<string>")).otherwise(
        F.split(trimmed, "[\\x20\\x09-\\x0D]+"))


def _repeat_words(words: Column) -> Column:
    """Words that lie in a 3-word window found twice or more. Equal windows become
    neighbours when (hash, position) pairs are sorted; the union of the marked windows
    is then added up from left to right. Texts without a repeat skip the sort."""
    def covered(h: Column) -> Column:
        pairs = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def marked(p: Column) -> Column:
            hit = F.filter(p, lambda x, i: (F.get(p, i - 1)["h"] == x["h"]).eqNullSafe(True)
                           | (F.get(p, i + 1)["h"] == x["h"]).eqNullSafe(True))
            at = F.array_sort(F.transform(hit, lambda x: x["i"]))
            start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end"))
            return F.aggregate(at, start, lambda acc, i: F.struct(
                (acc["n"] + (i + 3 - F.greatest(acc["end"], i))).cast("long").alias("n"),
                (i + 3).alias("end")), lambda acc: acc["n"])

        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(
            _let(pairs, marked))

    hashes = F.transform(F.slice(words, F.lit(1), F.size(words) - 2), lambda w, i: F.xxhash64(
        w, F.get(words, i + 1), F.get(words, i + 2)))
    return F.when(F.size(words) < 3, F.lit(0).cast("long")).otherwise(_let(hashes, covered))


def _counts(text: Column) -> Column:
    """All word and line counts of one text, as a struct."""
    def of_words(w: Column) -> Column:
        return F.struct(F.size(w).cast("long").alias("n_words"),
                        F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
                        _repeat_words(w).alias("n_repeat_words"))

    def of_lines(lines: Column) -> Column:
        return F.struct(F.size(lines).cast("long").alias("n_lines"),
                        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long")
                        .alias("n_dup_lines"))

    lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.btrim(x, F.lit(BLANKS))) > 0)
    return F.struct(_let(_words(text), of_words).alias("w"), _let(lines, of_lines).alias("l"),
                    F.regexp_count(text, F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
                    F.regexp_count(text, F.lit("[A-Z]")).cast("long").alias("n_upper"),
                    F.regexp_count(text, F.lit("[!?]")).cast("long").alias("n_shouts"),
                    F.regexp_count(text, F.lit("[.,]")).cast("long").alias("n_stops"))


BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_EXTRA = ("n_lines", "n_upper", "n_shouts", "n_stops")


def text_statistics(docs: DataFrame) -> DataFrame:
    """``(doc_id, counts...)``, one row per document row; a null text counts as empty."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    d = pick(docs, "doc_id", "text").select("doc_id", _counts(text).alias("c"))
    return d.select("doc_id", "c.w.*", "c.l.*", "c.n_symbols", "c.n_upper", "c.n_shouts",
                    "c.n_stops")


def base_failed() -> Column:
    return ((F.col("n_words") < MIN_WORDS)
            | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))


def _per(a: str, b: str) -> Column:
    return F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0))


#: What a condition can test: a name and the Spark expression over the counts.
FEATURES: dict[str, Column | str] = {
    "n_words": "n_words", "word_length": ("word_chars", "n_words"),
    "symbols_per_word": ("n_symbols", "n_words"), "dup_line_share": ("n_dup_lines", "n_lines"),
    "repeat_share": ("n_repeat_words", "n_words"), "upper_share": ("n_upper", "word_chars"),
    "shouts_per_word": ("n_shouts", "n_words"), "stops_per_word": ("n_stops", "n_words"),
}


def feature(name: str) -> Column:
    f = FEATURES[name]
    return F.col(f).cast("double") if isinstance(f, str) else _per(*f)


# ------------------------------------------------------------------- learning
@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def expr(self) -> Column:
        f = feature(self.feature)
        return f > self.threshold if self.above else f <= self.threshold

    def __str__(self):
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


@dataclass(frozen=True)
class Rule:
    """A conjunction that rejects; with its counts on the pruning rows."""

    conditions: tuple[Condition, ...]
    bad: int = 0
    good: int = 0

    def expr(self) -> Column:
        e = self.conditions[0].expr()
        for c in self.conditions[1:]:
            e = e & c.expr()
        return e

    def __str__(self):
        return f"reject if {' and '.join(map(str, self.conditions))} ({self.bad}:{self.good})"


@dataclass
class DecisionList:
    rules: list[Rule] = field(default_factory=list)

    def keeps(self) -> Column:
        """The ordered conditional: the first rule that holds decides; else keep."""
        if not self.rules:
            return F.lit(True)
        e = F.when(self.rules[0].expr(), F.lit(False))
        for r in self.rules[1:]:
            e = e.when(r.expr(), F.lit(False))
        return e.otherwise(F.lit(True))

    def rule_number(self) -> Column:
        """Which rule decided (1 is the first); null where none held."""
        e = F.lit(None).cast("int")
        for i in range(len(self.rules), 0, -1):
            e = F.when(self.rules[i - 1].expr(), F.lit(i)).otherwise(e)
        return e


def _log2(x):
    from math import log2
    return log2(x) if x > 0 else -60.0


def learn_decision_list(rows: DataFrame, *, bins: int = BINS, max_rules: int = MAX_RULES,
                        max_conditions: int = MAX_CONDITIONS,
                        min_precision: float = MIN_PRECISION) -> DecisionList:
    """Sequential covering over ``rows`` (the counts, and a boolean ``bad``).

    Two thirds of the rows grow rules, one third prunes them (by a hash of the id). A rule
    starts empty; the condition with the highest information gain is added while it gains,
    then trailing conditions are dropped while that raises (bad - good) / (bad + good) on
    the pruning rows. Rows that a rule covers leave both parts. The list ends when a rule
    is right too seldom on the pruning rows. Every step is one aggregate by (feature, bin):
    the driver sees ``features x bins`` counts, whatever the number of rows. Rows with a
    null label are left out; without any bad or good row the list is empty.
    """
    names = list(FEATURES)
    held = stored(rows.where("bad is not null").select(
        (F.pmod(F.xxhash64("doc_id"), F.lit(3)) == 0).alias("prune"), F.col("bad"),
        *[feature(n).alias(f"f_{n}") for n in names]), "labelled")
    quantiles = [i / bins for i in range(1, bins)]
    got = held.agg(F.count(F.lit(1)).alias("n"), *[
        F.percentile_approx(f"f_{n}", quantiles, 10_000).alias(n) for n in names]).first()
    if not got["n"]:
        return DecisionList()
    cuts = {n: sorted(set(got[n] or [])) for n in names}

    def test(c: Condition) -> Column:
        f = F.col(f"f_{c.feature}")
        return f > c.threshold if c.above else f <= c.threshold

    def covered(conditions) -> Column:
        e = F.lit(True)
        for c in conditions:
            e = e & test(c)
        return e

    def bin_of(n: str) -> Column:
        f = F.col(f"f_{n}")
        e = F.lit(0)
        for t in cuts[n]:
            e = e + (f > t).cast("int")
        return e

    binned = stored(held.select("prune", "bad", *[f"f_{n}" for n in names], F.array(*[
        F.struct(F.lit(n).alias("f"), bin_of(n).alias("b")) for n in names]).alias("bins")),
        "binned")
    rules: list[Rule] = []
    left = F.lit(True)
    for _ in range(max_rules):
        conditions: list[Condition] = []
        p0 = n0 = None
        while len(conditions) < max_conditions:
            counts = (binned.where(left & ~F.col("prune") & covered(conditions))
                      .select("bad", F.explode("bins").alias("x"))
                      .groupBy("x.f", "x.b").agg(
                          F.sum(F.col("bad").cast("long")).alias("p"),
                          F.sum((~F.col("bad")).cast("long")).alias("n")).collect())
            by = {n: [[0, 0] for _ in range(len(cuts[n]) + 1)] for n in names}
            for r in counts:
                by[r["f"]][r["b"]] = [r["p"], r["n"]]
            p, n = (sum(x[i] for x in by[names[0]]) for i in (0, 1))
            if p0 is None:
                p0, n0 = p, n
            if p < MIN_COVER or n == 0:
                break
            best = None
            for name in names:
                up = [p, n]
                for b, t in enumerate(cuts[name]):
                    up = [up[0] - by[name][b][0], up[1] - by[name][b][1]]
                    for above, (cp, cn) in ((True, up), (False, (p - up[0], n - up[1]))):
                        if cp >= MIN_COVER and cp + cn < p + n:
                            gain = cp * (_log2(cp / (cp + cn)) - _log2(p / (p + n)))
                            key = (gain, cp, -names.index(name))
                            if best is None or key > best[0]:
                                best = (key, Condition(name, above, float(t)))
            if best is None or best[0][0] <= 1e-9:
                break
            conditions.append(best[1])
        if not conditions:
            break
        on_prune = binned.where(left & F.col("prune")).agg(*[
            F.coalesce(F.sum((covered(conditions[:k]) & side).cast("long")), F.lit(0))
            .alias(f"{tag}{k}") for k in range(1, len(conditions) + 1)
            for tag, side in (("p", F.col("bad")), ("n", ~F.col("bad")))]).first()

        def worth(k):
            p, n = on_prune[f"p{k}"], on_prune[f"n{k}"]
            return ((p - n) / (p + n) if p + n else -1.0, -k)

        k = max(range(1, len(conditions) + 1), key=worth)
        p, n = on_prune[f"p{k}"], on_prune[f"n{k}"]
        if p + n == 0 or p / (p + n) < min_precision:
            break
        rules.append(Rule(tuple(conditions[:k]), p, n))
        left = left & ~covered(conditions[:k])
    return DecisionList(rules)


def judge(docs: DataFrame, labels: DataFrame, **learning) -> DataFrame:
    """``(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    kept, rule)``, one row per document row; ``rule`` numbers the rule that rejected.

    The list is learned from all rows whose id has a label (``labels(doc_id, quality)``,
    0 is bad). A null or empty text has zero counts and fails the base rules. Repeated rows
    are judged alike. Repeated labels of an id count by their least quality; null labels and
    ids are ignored, and without labels only the base rules decide. A text of any length is
    counted whole, by Spark's functions over its words as one array; an empty table gives no
    rows; other columns are ignored.
    """
    stats = stored(text_statistics(docs), "statistics")
    marks = (pick(labels, "doc_id", "quality").where("doc_id is not null and quality is not null")
             .groupBy("doc_id").agg((F.min("quality") == 0).alias("bad")))
    learned = learn_decision_list(stats.where(~base_failed()).join(marks, "doc_id"), **learning)
    return stats.select("doc_id", *BASE, base_failed().alias("base_failed"),
                        (~base_failed() & learned.keeps()).alias("kept"),
                        learned.rule_number().alias("rule"))


def keep_good(docs: DataFrame, labels: DataFrame, **learning) -> DataFrame:
    """The rows of ``docs`` (all columns) that ``judge`` keeps. The list is learned first;
    each row is then judged where it is read, without a join."""
    stats = stored(text_statistics(docs), "statistics")
    marks = (pick(labels, "doc_id", "quality").where("doc_id is not null and quality is not null")
             .groupBy("doc_id").agg((F.min("quality") == 0).alias("bad")))
    learned = learn_decision_list(stats.where(~base_failed()).join(marks, "doc_id"), **learning)
    flat, name = positional(docs)
    counted = flat.withColumn("c", _counts(F.coalesce(F.col(name["text"]).cast("string"),
                                                      F.lit(""))))
    inner = counted.select(*flat.columns, "c.w.*", "c.l.*", "c.n_symbols", "c.n_upper",
                           "c.n_shouts", "c.n_stops")
    return inner.where(~base_failed() & learned.keeps()).select(*flat.columns).toDF(*docs.columns)
