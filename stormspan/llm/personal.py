"""Personal data in texts: base patterns, weak supervision and a span classifier.

All of it is DataFrame expressions.  Base spans are matched by pattern and always count.
Further candidates (numbers in wider shapes, handles, and long strings of letters and digits as
access tokens are) are voted on by labelers of three kinds: shape patterns, gazetteers and
context words.  Context is what stands in the BEFORE characters ahead of a candidate, or since
the candidate before it.  Expectation-maximisation over the counts
of vote combinations estimates each labeler's reliability and each combination's probability; a
logistic span classifier is then trained on these soft labels, over features of the span that
the labelers do not see alone.  Both fits work on counts per combination, of which there are at
most COMBINATIONS, whatever the corpus; candidates over THRESHOLD are added as spans.

Patterns that repeat groups are written with single-character loops and look-arounds, because
the JVM matches those without recursion: very long matches cannot overflow its stack, and a run
of characters is looked at from its start only, so time stays in proportion to the text.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import free_name, spill

KINDS = ("email", "ip", "card", "phone")
#: Equal to  [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+  from the start of a run.
EMAIL = (
    r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@(?=[A-Za-z0-9-]++\.[A-Za-z0-9-])"
    r"[A-Za-z0-9-][A-Za-z0-9.-]*?(?<!\.)(?!\.?[A-Za-z0-9-])"
)
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
#: Equal to  [0-9]([\x20-]?[0-9])+.
CARD = r"[0-9](?=[\x20-]?[0-9])[0-9\x20-]*?(?<=[0-9])(?![\x20-]?[0-9])"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
#: Wider shapes, one after another: a string of 16 signs or more with letters and digits, a number
#: of seven signs or more, or a handle.
WIDE = (
    r"(?:(?<![A-Za-z0-9_-])(?=[A-Za-z0-9_-]{16})(?=[A-Za-z_-]*+[0-9])(?=[0-9_-]*+[A-Za-z])[A-Za-z0-9_-]++"
    r"|(?<![A-Za-z0-9])(?:[+(]?[0-9][0-9().\x20-]{5,}[0-9]|@[A-Za-z0-9_]{3,30})(?![A-Za-z0-9]))"
)
#: Signs before a candidate that the context labelers read.
BEFORE = 40

PHONE_WORDS = r"phone|tel|call|mobile|cell|fax|whatsapp|telefon|appel|llam"
CARD_WORDS = r"card|visa|mastercard|amex|iban|account|konto|carte|tarjeta|cuenta"
ID_WORDS = r"ssn|social security|passport|licen[cs]e no|tax id|personal|ausweis|pasaporte|dni|name is|born"
SECRET_WORDS = r"token|secret|passw(?:or)?d|pwd|api[_\x20-]?key|access[_\x20-]?key|private[_\x20-]?key|credentials?|bearer|passwort|contrase\u00f1a"
HANDLE_WORDS = r"follow|twitter|instagram|telegram|github|contact|user(?:name)?|profile|message"
OTHER_WORDS = r"order|invoice|version|isbn|total|page|line|figure|table|http|commit|build|revision|checksum|sha1|sha256|md5"
CUES = "|".join((PHONE_WORDS, CARD_WORDS, ID_WORDS))
#: What stands behind an at sign in source code and style sheets, as a gazetteer.
ANNOTATIONS = r"^@(?:param|returns?|throws|override|deprecated|author|since|see|media|import|charset|keyframes|property|staticmethod|classmethod|test)$"
#: First digits of card issuers, and dialling prefixes, as gazetteers.
ISSUERS = r"^(?:4|5[1-5]|2[2-7]|3[47]|6(?:011|5))"
DIALLING = r"^(?:\+|00)?(?:1|33|34|44|49|39|41|43|31|32)"

SPANS = "array<struct<kind:string,start:int,end:int,value:string,before:string>>"
#: Elements of one block of a running fold.
RUN = 128
FAR = 2**31 - 1
THRESHOLD = 0.9
ROUNDS = 50
#: Votes are -1, 0 or 1 of eight labelers; features take 5 * 4 * 2 * 2 * 2 * 4 values.
LABELERS = ("shape", "checksum", "issuer", "dialling", "mixture", "annotation", "cue", "counter")
COMBINATIONS = 3 ** len(LABELERS) * 640
#: A labeler's chance of a right vote stays between these: one worse than chance is found out,
#: and none is trusted blindly.
CHANCE = (0.2, 0.95)


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """The check digit of a string of 12 to 19 digits is right."""
    back = F.reverse(number)

    def add(total: Column, at: Column) -> Column:
        digit = F.substring(back, at, F.lit(1)).cast("int")
        twice = digit * 2
        return total + F.when(at % 2 == 1, digit).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    size = F.length(number)
    whole = F.aggregate(F.sequence(F.lit(1), size), F.lit(0), add) % 10 == 0
    return F.when(size.between(12, 19), whole).otherwise(False)


def valid(kind: str, value: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        part = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
        return value.rlike(rf"^{part}(?:\.{part}){{3}}$")
    if kind == "card":
        return luhn(digits(value))
    return F.length(digits(value)).between(9, 15)


def let(value: Column, body) -> Column:
    """``body`` of a value that is worked out once, also where lambdas use it again and again."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def before_each(values: Column, join, zero: int) -> Column:
    """For each integer of an array, what ``join`` makes of those before it.  Arrays have no
    running fold that appends without copying, so it runs in blocks: each starts from a fold
    over all before it, and copies only within itself."""
    return let(values, lambda held: runs_before(held, join, zero))


def runs_before(values: Column, join, zero: int) -> Column:
    def block(number: Column) -> Column:
        start = F.aggregate(F.slice(values, F.lit(1), number * RUN), F.lit(zero), join)
        state = F.struct(start.alias("now"), F.array().cast("array<int>").alias("out"))

        def add(held: Column, value: Column) -> Column:
            return F.struct(
                join(held["now"], value).alias("now"), F.concat(held["out"], F.array(held["now"])).alias("out")
            )

        return F.aggregate(F.slice(values, number * RUN + 1, F.lit(RUN)), state, add, lambda held: held["out"])

    blocks = F.sequence(F.lit(0), F.floor((F.size(values) - 1) / RUN).cast("int"))
    return F.when(F.size(values) > 0, F.flatten(F.transform(blocks, block))).otherwise(F.array().cast("array<int>"))


def matches(text: Column, pattern: str, worth: Column, kind: str, before: int = 0) -> Column:
    """Leftmost non-overlapping matches with their places in code points: what lies between
    two matches is matched too, and its length counted.  Every match begins where the last one
    ended, so a text is gone through once.  Texts that ``worth`` turns down are not searched."""
    gap_and_match = F.lit(rf"(?s)\G(.*?)({pattern})")
    gaps = F.when(worth, F.regexp_extract_all(text, gap_and_match, 1)).otherwise(F.array().cast("array<string>"))
    found = F.when(worth, F.regexp_extract_all(text, gap_and_match, 2)).otherwise(F.array().cast("array<string>"))
    both = F.arrays_zip(gaps.alias("gap"), found.alias("value"))
    def span(match: Column, at: Column) -> Column:
        start = at + F.length(match["gap"])
        return F.struct(
            F.lit(kind).alias("kind"),
            start.alias("start"),
            (start + F.length(match["value"])).alias("end"),
            match["value"].alias("value"),
            (F.right(match["gap"], F.lit(before)) if before else F.lit("")).alias("before"),
        )

    def placed(pairs: Column) -> Column:
        lengths = F.transform(pairs, lambda m: F.length(m["gap"]) + F.length(m["value"]))
        return F.zip_with(pairs, before_each(lengths, lambda a, b: a + b, 0), span)

    return F.when(worth, let(both, placed)).otherwise(F.array().cast(SPANS))


def base(text: Column) -> Column:
    """Base spans by start, then in the order of KINDS."""
    has_digit = text.rlike("[0-9]")
    worth = {"email": F.contains(text, F.lit("@")), "ip": has_digit, "card": has_digit, "phone": F.contains(text, F.lit("+"))}
    patterns = {"email": EMAIL, "ip": IP, "card": CARD, "phone": PHONE}

    def good(kind: str) -> Column:
        return F.filter(matches(text, patterns[kind], worth[kind], kind), lambda s: valid(kind, s["value"]))

    return ordered(F.concat(*map(good, KINDS)))


def ordered(spans: Column) -> Column:
    """By start, then kind as listed, then end."""
    rank = lambda s: F.array_position(F.array(*map(F.lit, (*KINDS, "other"))), s["kind"])
    keyed = F.transform(spans, lambda s: F.struct(s["start"], rank(s).alias("rank"), s["end"], s["kind"], s["value"], s["before"]))
    return F.transform(
        F.array_sort(keyed),
        lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value"), s["before"].alias("before")),
    )


def with_candidates(docs: DataFrame, text: str, spans: str, wide: str) -> DataFrame:
    """``docs`` with base spans and the wide candidates that touch none of them."""
    whole = F.coalesce(F.col(text), F.lit(""))
    joined, ahead, behind = (free_name(docs, name) for name in ("__every", "__ends", "__starts"))
    out = docs.withColumn(spans, base(whole))
    worth = whole.rlike("[0-9]") | F.contains(whole, F.lit("@"))
    found = matches(whole, WIDE, worth, "other", BEFORE)
    out = out.withColumn(wide, found)
    every = ordered(F.concat(spans, wide))
    ends = F.transform(every, lambda s: F.when(s["kind"] == "other", 0).otherwise(s["end"]))
    starts = F.transform(F.reverse(every), lambda s: F.when(s["kind"] == "other", FAR).otherwise(s["start"]))
    out = out.withColumn(joined, every).withColumn(ahead, before_each(ends, lambda a, b: F.greatest(a, b), 0))
    out = out.withColumn(behind, F.reverse(before_each(starts, lambda a, b: F.least(a, b), FAR)))
    zipped = F.arrays_zip(F.col(joined).alias("s"), F.col(ahead).alias("a"), F.col(behind).alias("b"))
    apart = F.filter(zipped, lambda z: (z["s"]["kind"] == "other") & (z["a"] <= z["s"]["start"]) & (z["b"] >= z["s"]["end"]))
    return out.withColumn(wide, F.transform(apart, lambda z: z["s"])).drop(joined, ahead, behind)


def sides(yes: Column, no: Column) -> Column:
    return F.when(yes, 1).when(no, -1).otherwise(0)


def form(value: Column) -> Column:
    """0: a number, 1: a handle, 2: a string of letters and digits."""
    return F.when(value.startswith("@"), 1).when(value.rlike("[A-Za-z]"), 2).otherwise(0)


def mixed(value: Column) -> Column:
    """Letters and digits change too often for words with a number."""
    return value.rlike("(?:[A-Za-z]+[0-9]+){4}") | value.rlike("(?:[0-9]+[A-Za-z]+){4}")


def cued(value: Column, lead: Column) -> Column:
    """The words ahead name the candidate's kind; between them and a token stand only signs."""
    kind = form(value)
    return (
        F.when(kind == 0, lead.rlike(rf"(?:{CUES})[^0-9]*$"))
        .when(kind == 1, lead.rlike(rf"(?:{CUES}|{HANDLE_WORDS})[^0-9]*$"))
        .otherwise(lead.rlike(rf"(?:{SECRET_WORDS}|{ID_WORDS})(?:\x20is)?[^A-Za-z0-9]{{0,8}}$"))
    )


def votes(span: Column) -> dict[str, Column]:
    """Of each labeler: 1 personal, -1 not, 0 abstains."""
    value, number, lead = span["value"], digits(span["value"]), F.lower(span["before"])
    size, kind = F.length(number), form(span["value"])
    plain = kind == 0
    grouped_ = value.rlike(r"^[+(]?[0-9]{1,4}[)\x20.-]+[0-9]{2,4}[\x20.-][0-9]{2,4}(?:[\x20.-][0-9]{2,4})*$")
    return {
        "shape": sides(plain & grouped_ & size.between(7, 19), plain & ((size < 7) | (size > 19))),
        "checksum": F.when(plain & size.between(12, 19), F.when(luhn(number), 1).otherwise(-1)).otherwise(0),
        "issuer": F.when(plain & size.between(13, 19), F.when(number.rlike(ISSUERS), 1).otherwise(-1)).otherwise(0),
        "dialling": F.when(plain & size.between(9, 13) & value.rlike(DIALLING), 1).otherwise(0),
        "mixture": F.when(kind == 2, F.when(mixed(value), 1).otherwise(-1)).otherwise(0),
        "annotation": F.when((kind == 1) & F.lower(value).rlike(ANNOTATIONS), -1).otherwise(0),
        "cue": F.when(cued(value, lead), 1).when(kind > 0, -1).otherwise(0),
        "counter": F.when(lead.rlike(rf"(?:{OTHER_WORDS})[^0-9]*$"), -1).otherwise(0),
    }


def features(span: Column) -> dict[str, Column]:
    """Small integers; the classifier takes each value as an indicator."""
    value, lead = span["value"], span["before"]
    size, kind = F.length(digits(value)), form(span["value"])
    return {
        "length": F.when(size < 7, 0).when(size < 9, 1).when(size < 12, 2).when(size < 16, 3).otherwise(4),
        "breaks": F.when(kind == 0, F.least(F.length(F.regexp_replace(value, r"[0-9+]", "")), F.lit(3))).otherwise(0),
        "plus": value.startswith("+").cast("int"),
        "after_word": lead.rlike(r"[A-Za-z]\x20$").cast("int"),
        "after_cue": cued(value, F.lower(lead)).cast("int"),
        "form": F.when(kind == 2, F.when(mixed(value), 3).otherwise(2)).otherwise(kind),
    }


SIZES = {"length": 5, "breaks": 4, "plus": 2, "after_word": 2, "after_cue": 2, "form": 4}


def agreement(counts: dict[tuple[int, ...], int]) -> dict[tuple[int, ...], float]:
    """Expectation-maximisation over vote combinations: the probability of each that the span is
    personal.  A labeler has one chance of a right vote per class, where it votes at all; all
    start as better than chance, and a prior of one vote each way keeps them inside (0, 1).  What
    follows a combination's votes is its form; the share of personal spans is one per form, so
    that many tokens say nothing about numbers."""
    right = [[0.7, 0.7] for _ in LABELERS]  # where personal, where not
    forms = {v[len(LABELERS) :] for v in counts}
    prior, out = dict.fromkeys(forms, 0.5), {v: 0.5 for v in counts}
    for _ in range(ROUNDS):
        for vote in counts:
            share = prior[vote[len(LABELERS) :]]
            yes, no = math.log(share), math.log(1 - share)
            for k, v in enumerate(vote[: len(LABELERS)]):
                if v:
                    yes += math.log(right[k][0] if v > 0 else 1 - right[k][0])
                    no += math.log(right[k][1] if v < 0 else 1 - right[k][1])
            out[vote] = 1 / (1 + math.exp(min(50, max(-50, no - yes))))
        for form_ in forms:
            own = [(n, out[v]) for v, n in counts.items() if v[len(LABELERS) :] == form_]
            prior[form_] = (sum(n * p for n, p in own) + 1) / (sum(n for n, _ in own) + 2)
        for k in range(len(LABELERS)):
            cast = [(v[k], n, out[v]) for v, n in counts.items() if v[k]]
            hits = sum(n * p for v, n, p in cast if v > 0), sum(n * (1 - p) for v, n, p in cast if v < 0)
            sums = sum(n * p for _, n, p in cast), sum(n * (1 - p) for _, n, p in cast)
            right[k] = [min(CHANCE[1], max(CHANCE[0], (h + 0.7) / (s + 1))) for h, s in zip(hits, sums)]
    return out


def logistic(rows: list[tuple[tuple[int, ...], float, float]]) -> list[float]:
    """Weights (bias, then one per feature value) from (features, count, probability), by
    gradient steps with a small ridge."""
    width = 1 + sum(SIZES.values())
    starts = [1 + sum(list(SIZES.values())[:k]) for k in range(len(SIZES))]
    weights, total = [0.0] * width, sum(n for _, n, _ in rows) or 1.0
    for _ in range(300):
        grad = [1e-3 * w for w in weights]
        for values, n, p in rows:
            at = [0, *(s + v for s, v in zip(starts, values))]
            error = (1 / (1 + math.exp(-max(-50.0, min(50.0, sum(weights[k] for k in at))))) - p) * n / total
            for k in at:
                grad[k] += error
        weights = [w - 1.5 * g for w, g in zip(weights, grad)]
    return weights


def fit(table: DataFrame, wide: str) -> list[float]:
    """Classifier weights from the candidates of all rows; no candidates, no weights."""
    span = F.col("s")
    spans = table.select(F.explode(wide).alias("s"))
    columns = [c.alias(f"v_{n}") for n, c in votes(span).items()] + [c.alias(f"f_{n}") for n, c in features(span).items()]
    names = [f"v_{n}" for n in LABELERS] + [f"f_{n}" for n in SIZES]
    rows = spans.select(*columns).groupBy(*names).count().collect()  # COMBINATIONS rows at most
    seen: dict[tuple[int, ...], int] = {}

    def judged(row) -> tuple[int, ...]:
        return (*row[: len(LABELERS)], min(row["f_form"], 2))

    for row in rows:
        seen[judged(row)] = seen.get(judged(row), 0) + row["count"]
    if not seen:
        return []
    likely = agreement(seen)
    # Combinations on which nobody votes teach nothing.
    return logistic([(tuple(r[len(LABELERS) : -1]), float(r["count"]), likely[judged(r)]) for r in rows if any(r[: len(LABELERS)])])


def added(wide: Column, weights: list[float]) -> Column:
    """The candidates over THRESHOLD, by the classifier as an expression."""
    if not weights:
        return F.filter(wide, lambda s: F.lit(False))

    def over(span: Column) -> Column:
        terms, start = [F.lit(weights[0])], 1
        for name, column in features(span).items():
            own = weights[start : start + SIZES[name]]
            terms.append(F.element_at(F.array(*map(F.lit, own)), column + 1))
            start += SIZES[name]
        return reduce(lambda a, b: a + b, terms) > math.log(THRESHOLD / (1 - THRESHOLD))

    return F.filter(wide, over)


def named(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def find(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_other) per row.

    Offsets are code points of the whole text, ends exclusive.  A null or empty text has no
    spans.  Rows are judged each for itself, so repeated rows agree; the classifier is fitted
    on the candidates of all rows.  Other columns are not looked at.
    """
    table = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    made = spill(with_candidates(table, "text", "base", "wide").select("key", "base", "wide"))
    weights = fit(made, "wide")
    made = made.withColumn("more", added(F.col("wide"), weights))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return made.select(
        F.col("key").alias(key),
        *(count(k).alias(f"n_{k}") for k in KINDS),
        F.sha2(named(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        named(ordered(F.concat("base", "more"))).alias("spans"),
        F.size("more").cast("long").alias("n_other"),
    )


def merged(spans: Column, ends: Column) -> Column:
    """Overlapping spans of a sorted list as one, named by the first; ``ends`` holds the
    furthest end before each.  A group ends where the furthest end before the next begins."""
    zipped = F.arrays_zip(spans.alias("s"), ends.alias("before"))
    last = F.array_max(F.transform(spans, lambda s: s["end"]))

    def closed(firsts: Column) -> Column:
        after = F.concat(F.slice(F.transform(firsts, lambda z: z["before"]), F.lit(2), F.size(firsts)), F.array(last))
        return F.zip_with(
            firsts, after, lambda z, end: F.struct(z["s"]["kind"].alias("kind"), z["s"]["start"].alias("start"), end.alias("end"))
        )

    return let(F.filter(zipped, lambda z: z["before"] <= z["s"]["start"]), closed)


def masked(text: Column, cut: Column) -> Column:
    """``text`` with the groups of ``cut`` in brackets.  The text is parted at every RUN-th
    group first, so that no place is counted from the text's start more often than that."""

    def end_before(number: Column) -> Column:
        return F.when(number == 0, 0).otherwise(F.get(cut, number - 1)["end"])

    def block(number: Column) -> Column:
        own = F.slice(cut, number * RUN + 1, F.lit(RUN))
        start = end_before(number * RUN)
        part = F.substring(text, start + 1, F.element_at(own, -1)["end"] - start)
        return let(F.struct(own.alias("own"), start.alias("start"), part.alias("part")), parts_of)

    def parts_of(held: Column) -> Column:
        own, start, part = held["own"], held["start"], held["part"]

        def piece(span: Column, k: Column) -> Column:
            at = F.when(k == 0, start).otherwise(F.get(own, k - 1)["end"])
            kept = F.substring(part, at - start + 1, span["start"] - at)
            return F.concat(kept, F.lit("["), F.upper(span["kind"]), F.lit("]"))

        return F.array_join(F.transform(own, piece), "")

    blocks = F.sequence(F.lit(0), F.floor((F.size(cut) - 1) / RUN).cast("int"))
    tail = F.substring(text, F.element_at(cut, -1)["end"] + 1, F.length(text))
    return F.concat(F.array_join(F.transform(blocks, block), ""), tail)


def mask(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with every span in ``text`` replaced by its kind in brackets, as [EMAIL].

    Overlapping spans are replaced as one.  Null texts stay null; texts without spans stay as
    they are.  Row count, order of columns and all other columns are kept.
    """
    spans, wide, ends, cut = (free_name(docs, name) for name in ("__spans", "__wide", "__furthest", "__cut"))
    table = with_candidates(docs, text, spans, wide)
    weights = fit(table.select(wide), wide)
    table = table.withColumn(spans, ordered(F.concat(spans, added(F.col(wide), weights))))
    furthest = before_each(F.transform(spans, lambda s: s["end"]), lambda a, b: F.greatest(a, b), 0)
    table = table.withColumn(ends, furthest).withColumn(cut, merged(F.col(spans), F.col(ends)))
    whole = F.col(text)
    return table.withColumn(text, F.when(F.size(spans) > 0, let(F.col(cut), lambda groups: masked(whole, groups))).otherwise(whole)).select(docs.columns)
