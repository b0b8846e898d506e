"""Quality rules with risk-controlled cutoffs.

Each rule is a share of a text's words or lines that is high in bad texts.  Per stratum (length
band) a joint cutoff, one per rule that is of use, is proposed and then certified as a whole:

1. One good labelled text in TUNE, and all bad ones, propose.  A rule's cutoff is the strictest
   that its share of the risk allows on these good texts, moved away by MARGIN.  Rules are then
   taken greedily while the next one rejects bad texts, missed by those before, worth more than
   the good ones it costs and one more, a good one weighing PRICE; ties go to the order of RULES.
2. The other good labelled texts, which had no say in the proposal, certify: a stratum's cutoffs
   hold if the exact binomial (Clopper-Pearson) bound on the share of good texts that any of its
   rules rejects is at most RISK.  There is one hypothesis per stratum, and Holm's procedure
   over the strata corrects for their number.

So with probability 1 - DELTA no stratum loses more than RISK of its good texts to all rules
together.  A stratum with too few labels (149 to 217 good ones that certify, at the defaults
and without a loss) gets no cutoff: it loses nothing.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import held_out, spill

RISK = 0.02
DELTA = 0.05
PRICE = 10
#: One good labelled text in so many proposes cutoffs; the others certify them.
TUNE = 5
#: A proposed cutoff lies this much, and one step, above what the proposing good texts need.
MARGIN = 0.1
MIN_WORDS = 50
#: Upper ends of the length bands in words; the last band is open.
BANDS = (100, 300, 1000)
#: Cutoffs are multiples of this share, from STEPS of them down.
STEP, STEPS = 0.01, 200
RULES = ("symbol_rate", "dup_line_rate", "repeat_rate", "loud_rate", "odd_end_rate", "mean_length")
SYMBOLS = b"#*$%&|<>"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_loud", "n_odd_end")


def counts(text: str | None) -> tuple[int, ...]:
    """The COUNTS of one text.  Words are parted by ASCII white space."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    size = len(words)
    chars = sum(map(len, words))
    if not raw.isascii():
        chars -= int((np.frombuffer(raw, np.int8) < -64).sum())  # bytes inside a character
    symbols = sum(map(raw.count, SYMBOLS_EACH))
    seen, repeated, filled = set(), 0, 0
    for line in raw.split(b"\n"):
        if not line.isspace() and line:
            filled += 1
            repeated += line in seen
            seen.add(line)
    often = 0
    if size >= 4:
        windows = list(zip(words, words[1:], words[2:]))
        if len(set(windows)) < len(windows):
            first, marked = {}, np.zeros(size, bool)
            for at, window in enumerate(windows):
                before = first.setdefault(window, at)
                if before != at:
                    marked[before : before + 3] = True
                    marked[at : at + 3] = True
            often = int(marked.sum())
    loud = sum([w.isupper() and len(w) > 1 for w in words])
    odd = sum([w[-1] in ODD for w in words])
    return size, chars, symbols, repeated, often, filled, loud, odd


SYMBOLS_EACH = [bytes([b]) for b in SYMBOLS]
ODD = frozenset(b"#*$%&|<>!?=~^_")


def measured(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, COUNTS...) per row."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = np.array([counts(t.as_py()) for t in batch.column(1)], np.int64).reshape(-1, len(COUNTS))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c) for c in made.T)], [key, *COUNTS])

    return docs.select(key, text).mapInArrow(run, f"`{key}` {kind}, " + ", ".join(f"{c} long" for c in COUNTS))


def band() -> Column:
    out = F.lit(len(BANDS))
    for k, end in reversed(list(enumerate(BANDS))):
        out = F.when(F.col("n_words") < end, k).otherwise(out)
    return out


def rates() -> dict[str, Column]:
    words = F.greatest("n_words", F.lit(1))
    return {
        "symbol_rate": F.col("n_symbols") / words,
        "dup_line_rate": F.col("n_dup_lines") / F.greatest("n_lines", F.lit(1)),
        "repeat_rate": F.col("n_repeat_words") / words,
        "loud_rate": F.col("n_loud") / words,
        "odd_end_rate": F.col("n_odd_end") / words,
        "mean_length": F.col("word_chars") / words / 20,
    }


def failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def at_most(k: int, n: int, p: float) -> float:
    """P(X <= k) for X binomial(n, p), exactly, from the largest term down."""
    if k >= n:
        return 1.0
    term = math.exp(
        math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) + k * math.log(p) + (n - k) * math.log1p(-p)
    )
    total, j = term, k
    while j > 0 and term > total * 1e-17:
        term *= j / (n - j + 1) * (1 - p) / p
        total += term
        j -= 1
    return min(1.0, total)


def p_value(rejected: int, good: int, risk: float) -> float:
    """Of the hypothesis that more than ``risk`` of the good texts are rejected, exactly.  From
    the allowed count on it is not worth telling from 1, which also keeps the sum descending."""
    return at_most(rejected, good, risk) if good > 0 and rejected < good * risk else 1.0


def holm(p: dict[int, float], delta: float) -> set[int]:
    """The hypotheses that Holm's step-down procedure rejects at level ``delta``."""
    held = set()
    for place, (name, value) in enumerate(sorted(p.items(), key=lambda item: (item[1], item[0]))):
        if value > delta / (len(p) - place):
            break
        held.add(name)
    return held


def propose(steps: dict[tuple[int, int], int], risk: float) -> int | None:
    """A rule's cutoff in steps from {(step, good): texts}; None without good texts."""
    total = sum(n for (_, good), n in steps.items() if good)
    if not total:
        return None
    allowed, lost, cutoff = int(total * risk), 0, STEPS
    while cutoff > 0 and lost + steps.get((cutoff, 1), 0) <= allowed:  # rejected: step > cutoff
        lost += steps.get((cutoff, 1), 0)
        cutoff -= 1
    return math.ceil(cutoff * (1 + MARGIN)) + 1


def useful(patterns: dict[tuple[int, int], int], rules: int) -> int:
    """The rules worth taking, as bits, from {(bits of the rules a text is over, good): texts}."""
    taken = 0
    while True:
        worth = []
        for k in range(rules):
            fresh = {kind: sum(n for (bits, good), n in patterns.items() if good == kind and bits >> k & 1 and not bits & taken) for kind in (0, 1)}
            worth.append((fresh[0] - PRICE * (fresh[1] + 1), -k))
        best, k = max(worth)
        if best <= 0:
            return taken
        taken |= 1 << -k


def over(cutoffs: dict[tuple[int, str], float]) -> Column:
    """True where a rule's rate is over its cutoff in the text's band."""
    found = F.lit(False)
    values = rates()
    for (stratum, rule), cutoff in sorted(cutoffs.items()):
        steps = F.least(F.ceil(values[rule] / STEP), F.lit(STEPS))
        found = found | ((band() == stratum) & (steps > round(cutoff / STEP)))
    return found


def choose(
    table: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "quality", risk: float = RISK, delta: float = DELTA
) -> dict[tuple[int, str], float]:
    """{(band, rule): cutoff}: a text is rejected if its rate is over the cutoff.

    From labels outside the held-out fold; a key is good if any of its labels is 1, and bad if
    all are 0.  Base rules come first: texts they fail do not count here.  Only counts leave
    the executors: bands x rules x steps x 2 of them at most, then bands x sets of rules x 3.
    """
    known = labels.filter(F.col(label).isNotNull() & ~held_out(F.col(key)))
    known = known.groupBy(F.col(key).alias("known_key")).agg(F.max((F.col(label) == 1).cast("int")).alias("good"))
    proposes = F.crc32(F.concat(F.lit("tune"), F.col("known_key").cast("string"))) % TUNE == 0
    known = known.withColumn("proposes", (F.col("good") == 0) | proposes)
    own = table.filter(~failed()).join(known, F.col(key) == F.col("known_key"))
    rules = F.array(*(F.struct(F.lit(n).alias("rule"), F.least(F.ceil(r / STEP), F.lit(STEPS)).alias("step")) for n, r in rates().items()))
    counted = (
        own.filter("proposes")
        .select("good", band().alias("band"), F.explode(rules).alias("r"))
        .groupBy("band", "r.rule", "r.step", "good")
        .count()
    )
    at: dict[tuple[int, str], dict[tuple[int, int], int]] = defaultdict(dict)
    for row in counted.collect():
        at[row["band"], row["rule"]][row["step"], row["good"]] = row["count"]
    found = {place: propose(steps, risk / (2 * len(RULES))) for place, steps in at.items()}
    cutoffs = {place: step * STEP for place, step in found.items() if step is not None}
    alone = [{place: cutoff for place, cutoff in cutoffs.items() if place[1] == rule} for rule in RULES]
    bits = reduce(Column.__add__, (F.when(over(own_cutoffs), 1 << k).otherwise(0) for k, own_cutoffs in enumerate(alone)))
    judged = own.select(band().alias("band"), bits.alias("bits"), "good", "proposes").groupBy("band", "bits", "good", "proposes").count()
    patterns: dict[tuple[int, bool], dict[tuple[int, int], int]] = defaultdict(dict)
    for row in judged.collect():
        patterns[row["band"], row["proposes"]][row["bits"], row["good"]] = row["count"]
    taken = {stratum: useful(patterns[stratum, True], len(RULES)) for stratum in {b for b, _ in cutoffs}}
    tests = {}
    for stratum, rules_taken in taken.items():
        if rules_taken:
            certifying = patterns[stratum, False]
            lost = sum(n for (over_bits, _), n in certifying.items() if over_bits & rules_taken)
            tests[stratum] = p_value(lost, sum(certifying.values()), risk)
    held = holm(tests, delta)
    return {
        (stratum, rule): cutoff
        for (stratum, rule), cutoff in cutoffs.items()
        if stratum in held and taken[stratum] >> RULES.index(rule) & 1
    }


def verdict(table: DataFrame, cutoffs: dict[tuple[int, str], float]) -> DataFrame:
    """``table`` with base_failed and kept."""
    return table.withColumn("base_failed", failed()).withColumn("kept", ~failed() & ~over(cutoffs))


def apply(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """(key, COUNTS, base_failed, kept) per row.

    A null or empty text has no words and fails the base rules.  Equal rows get equal rows; a
    null key is judged like any other and never learned from.  Without labels only the base
    rules reject.  Other columns are not looked at.
    """
    table = spill(measured(docs, key, text))
    return verdict(table, choose(table, labels, key, **how))
