"""Personal data by weak supervision, in DataFrame functions only.

Fixed patterns find the base spans. A wider pattern finds candidates, and three labelers vote on each: its form, a
gazetteer of prefixes and endings, and the words before it. Expectation-maximisation over the counts of vote patterns
estimates how reliable each labeler is; the posteriors then weigh the counts from which a naive Bayes classifier of a
span's shape and votes is trained. Candidates that it accepts join the base spans. The corpus is read once; what EM sees
are counts of vote and shape combinations, whose number is bounded by the labelers and not by the data.
"""

from __future__ import annotations

import math
from collections import defaultdict

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rasterloom.llm.common import checkpointed, table

#: The patterns as the base names them, written so that no run of characters is tried from each of its places: a match
#: begins where a run begins or where the last match ended, and repeats are possessive.
_ADDRESS = r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)" + _ADDRESS
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
#: Candidates: addresses with at-signs and dots spelt or spaced out, and numbers of seven digits or more.
CONTACT = (
    r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++\x20?(?:@|\[at\]|\(at\))\x20?[A-Za-z0-9-]++"
    r"(?:\x20?(?:\.|\[dot\]|\(dot\))\x20?[A-Za-z0-9-]++)++"
)
NUMBER = r"(?<![A-Za-z0-9.])\+?\(?[0-9]++(?:[\x20().-]{1,2}[0-9]++)*+"
KINDS = ("email", "ip", "card", "phone")
ADDED = ("contact", "number")
#: Fixed gazetteers.
TLDS = "com|org|net|edu|gov|info|biz|io|co|de|fr|es|it|uk|us|eu|ch|at|nl|be|pt|pl|mx|ar|br|ca|au|jp|cn|in"
CALLING_CODES = "1|7|20|27|3[0-469]|4[0-13-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]"
CARD_PREFIXES = "4|5[1-5]|2[2-7]|3[47]|6011|65"
#: Fixed cue words before a span.
CUES = "mail|contact|write|phone|tel|call|fax|mobile|cell|whatsapp|card|visa|iban|account|address|ssn|passport|reach"
COUNTER_CUES = "isbn|issn|order|invoice|version|page|chapter|figure|table|item|serial|doi|art|vol"
THRESHOLD = 0.9
_CONTEXT = 24
_ROUNDS = 50
_NO_SPANS = "cast(array() as array<struct<kind:string,start:int,end:int>>)"
_EMPTY = "cast(array() as array<struct<start:int,end:int,s:string,before:string>>)"


def _running(lengths: Column) -> Column:
    """Running sums of an array of whole numbers, in as many passes as its size has binary digits."""
    digits = F.ceil(F.log2(F.greatest(F.size(lengths), F.lit(1)) + 1)).cast("int")

    def passed(sums: Column, k: Column) -> Column:
        return F.transform(sums, lambda x, i: x + F.coalesce(F.get(sums, i - F.pow(F.lit(2), k).cast("int")), F.lit(0)))

    return F.aggregate(F.sequence(F.lit(0), digits - 1), lengths, passed)


def _bound(value: Column, f) -> Column:
    """``f`` of ``value``, which is evaluated once however often ``f`` uses it."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def _found(text: str, pattern: str, hint: Column) -> Column:
    """Non-overlapping matches as structs (start, end, s, before); offsets are in code points. None unless ``hint``.

    Offsets are running sums of the lengths of matches and of the gaps before them, so that a text of n matches takes
    n log n steps.
    """
    pairs = F.zip_with(
        F.split(text, pattern, -1),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
        lambda gap, s: F.struct(F.length(gap).alias("gap"), s.alias("s"), F.lower(F.substring(gap, -_CONTEXT, _CONTEXT)).alias("before")),
    )

    def spans(found: Column) -> Column:
        ends = _running(F.transform(found, lambda x: F.coalesce(x["gap"] + F.length(x["s"]), F.lit(0))))
        return F.zip_with(
            found,
            ends,
            lambda x, end: F.struct((end - F.length(x["s"])).alias("start"), end.alias("end"), x["s"].alias("s"), x["before"].alias("before")),
        )

    made = _bound(F.filter(pairs, lambda x: x["s"].isNotNull()), spans)
    return F.when(hint, made).otherwise(F.expr(_EMPTY))


def _overlapped(spans: Column, start: Column, end: Column) -> Column:
    """Whether one of ``spans``, in order and apart from each other, has a place of start..end: a binary search.

    The last span that begins before ``end`` is the one to look at.
    """
    digits = F.ceil(F.log2(F.size(spans) + 1)).cast("int")

    def step(below: Column, k: Column) -> Column:
        more = below + F.pow(F.lit(2), digits - 1 - k).cast("int")
        return F.when(F.coalesce(F.get(spans, more - 1)["start"] < end, F.lit(False)), more).otherwise(below)

    below = F.aggregate(F.sequence(F.lit(0), digits), F.lit(0), step)
    return F.coalesce(F.get(spans, below - 1)["end"] > start, F.lit(False))


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    size = F.length(digits)

    def step(acc: Column, i: Column) -> Column:
        digit = F.substring(digits, size - i, F.lit(1)).cast("int")
        twice = digit * 2
        return acc + F.when(i % 2 == 0, digit).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    return F.aggregate(F.sequence(F.lit(0), size - 1), F.lit(0), step) % 10 == 0


def _is_ip(s: Column) -> Column:
    return s.rlike(r"^0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])(?:\.0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])){3}$")


def _is_card(s: Column) -> Column:
    digits = _digits(s)
    return F.when(F.length(digits).between(16, 19), _luhn(digits)).otherwise(False)


def _is_phone(s: Column) -> Column:
    return F.length(_digits(s)).between(8, 15)


def _candidate(kind: str, x: Column) -> Column:
    """Votes (1, 0 for none, -1) and shape of a candidate."""
    s, digits = x["s"], _digits(x["s"])
    size = F.length(digits)
    if kind == "contact":
        form = F.when(s.rlike(f"^{_ADDRESS}$"), 1).when(s.rlike(r"\(at\)|\[at\]"), 1).otherwise(0)
        listed = F.when(s.rlike(rf"(?i)[.\])]\x20?(?:{TLDS})$"), 1).otherwise(-1)
        shape = F.concat(F.when(s.contains("@"), "@").otherwise("a"), F.when(s.contains(" "), "s").otherwise("-"))
    else:
        phone, card = s.startswith("+") & size.between(8, 15), size.between(16, 19) & _is_card(s)
        ip = _is_ip(s)
        same = digits.rlike(r"^(.)\1*$")
        form = F.when(same, -1).when(phone | card | ip, 1).when(s == digits, -1).otherwise(0)
        code = s.rlike(rf"^\+(?:{CALLING_CODES})")
        prefix = digits.rlike(rf"^(?:{CARD_PREFIXES})")
        listed = F.when(code | (size.between(15, 19) & prefix), 1).when(size > 19, -1).otherwise(0)
        shape = F.concat(
            F.least(size, F.lit(20)).cast("string"),
            F.when(s.startswith("+"), "+").otherwise("-"),
            F.when(s == digits, "d").when(s.contains("."), ".").otherwise("s"),
        )
    cue = F.when(x["before"].rlike(rf"\b(?:{CUES})"), 1).when(x["before"].rlike(rf"\b(?:{COUNTER_CUES})"), -1).otherwise(0)
    votes = F.concat_ws("", *[F.when(v > 0, "+").when(v < 0, "-").otherwise("0") for v in (form, listed, cue)])
    return F.struct(
        F.lit(kind).alias("kind"),
        x["start"].alias("start"),
        x["end"].alias("end"),
        F.concat(F.lit(kind), F.lit("/"), votes, F.lit("/"), shape).alias("combo"),
    )


def _base(kind: str, found: Column, rule) -> Column:
    if rule is not None:
        found = F.filter(found, lambda x: rule(x["s"]))
    return F.transform(found, lambda x: F.struct(F.lit(kind).alias("kind"), x["start"].alias("start"), x["end"].alias("end")))


def _count(kind: str) -> Column:
    return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")


def extracted(docs: DataFrame) -> DataFrame:
    """(doc_id, base: spans of the fixed patterns in order, candidates) for each row of ``docs``."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    text = F.col("text")
    digit = text.rlike("[0-9]")
    hints = {"email": text.contains("@"), "ip": text.rlike(r"[0-9]\.[0-9]"), "card": text.rlike(r"[0-9](?:[\x20-]?[0-9]){15}"), "phone": text.contains("+")}
    patterns = {"email": EMAIL, "ip": IP, "card": CARD, "phone": PHONE}
    rules = {"email": None, "ip": _is_ip, "card": _is_card, "phone": _is_phone}
    base = [_base(kind, _found("text", patterns[kind], hints[kind]), rules[kind]) for kind in KINDS]
    contact = _found("text", CONTACT, text.contains("@") | text.rlike(r"[\[(]at[\])]"))
    number = F.filter(_found("text", NUMBER, digit & text.rlike(r"[0-9](?:[\x20().-]{0,2}[0-9]){6}")), lambda x: F.length(_digits(x["s"])) >= 7)
    candidates = F.concat(
        F.transform(contact, lambda x: _candidate("contact", x)), F.transform(number, lambda x: _candidate("number", x))
    )
    return rows.select("doc_id", F.concat(*base).alias("base"), candidates.alias("candidates"))


def reliabilities(counts: dict[str, int], rounds: int = _ROUNDS) -> dict[str, float]:
    """Posterior of each vote pattern ("+0-") by expectation-maximisation; each labeler has its own confusion rates."""
    if not counts:
        return {}
    labelers = len(next(iter(counts)))
    values = {"+": 1.0, "0": 0.0, "-": -1.0}
    posterior = {v: 1 / (1 + math.exp(-sum(values[c] for c in v))) for v in counts}
    for _ in range(rounds):
        total = sum(counts.values())
        share = (sum(counts[v] * posterior[v] for v in counts) + 1) / (total + 2)
        tables = []
        for i in range(labelers):
            seen = {(c, side): 1.0 for c in values for side in (0, 1)}
            seen["+", 1] += 2
            seen["-", 0] += 2
            for v, n in counts.items():
                seen[v[i], 1] += n * posterior[v]
                seen[v[i], 0] += n * (1 - posterior[v])
            sums = [sum(seen[c, side] for c in values) for side in (0, 1)]
            tables.append({c: math.log(seen[c, 1] / sums[1]) - math.log(seen[c, 0] / sums[0]) for c in values})
        logit = math.log(share / (1 - share))
        posterior = {v: 1 / (1 + math.exp(-min(max(logit + sum(t[c] for t, c in zip(tables, v)), -30), 30))) for v in counts}
    return posterior


def classifier(counts: dict[str, int]) -> dict[str, float]:
    """Probability of each combination kind/votes/shape: naive Bayes trained on the posteriors of the votes."""
    out = {}
    for kind in ADDED:
        own = {tuple(c.split("/")[1:]): n for c, n in counts.items() if c.startswith(kind + "/")}
        by_votes: dict[str, int] = defaultdict(int)
        for (votes, _), n in own.items():
            by_votes[votes] += n
        posterior = reliabilities(dict(by_votes))
        positive = sum(n * posterior[votes] for (votes, _), n in own.items())
        sides = (sum(own.values()) - positive + 1, positive + 1)
        shapes: dict[tuple[str, int], float] = defaultdict(lambda: 0.5)
        for (votes, shape), n in own.items():
            shapes[shape, 1] += n * posterior[votes]
            shapes[shape, 0] += n * (1 - posterior[votes])
        for votes, shape in own:
            p = min(max(posterior[votes], 1e-9), 1 - 1e-9)
            odds = math.log(p / (1 - p)) + math.log(shapes[shape, 1] / sides[1]) - math.log(shapes[shape, 0] / sides[0])
            out[f"{kind}/{votes}/{shape}"] = 1 / (1 + math.exp(-min(max(odds, -30), 30)))
    return out


def _apart(found: Column, kind: str) -> Column:
    """Those of the candidates that no base span of ``kind`` overlaps; spans of a kind are apart and in order."""
    own = F.filter("base", lambda b: b["kind"] == kind)
    return _bound(own, lambda spans: F.filter(found, lambda c: ~_overlapped(spans, c["start"], c["end"])))


def detected(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, base, added) for each row of ``docs`` (doc_id, text): arrays of spans (kind, start, end).

    base has the fixed patterns' spans by kind as listed, then start; added has the candidates that the classifier
    accepts and no base span overlaps, in the same order. Null texts count as empty and have none; repeated rows each
    return and each count; other columns are ignored; an empty table gives none. Whole texts are read.
    """
    rows = checkpointed(extracted(docs))
    combos = rows.select(F.explode("candidates.combo").alias("combo")).groupBy("combo").count()
    accepted = [c for c, p in classifier({r.combo: r["count"] for r in combos.collect()}).items() if p >= threshold]
    if not accepted:
        return rows.select("doc_id", "base", F.expr(_NO_SPANS).alias("added"))

    found = F.filter("candidates", lambda c: c["combo"].isin(*accepted))
    for kind in KINDS:
        found = _apart(found, kind)
    added = F.transform(found, lambda c: F.struct(c["kind"].alias("kind"), c["start"].alias("start"), c["end"].alias("end")))
    return rows.select("doc_id", "base", F.when(F.size("candidates") > 0, added).otherwise(F.expr(_NO_SPANS)).alias("added"))


def written(spans: Column | str) -> Column:
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = detected(table(spark, sf_dir, "documents"))
    counts = [_count(kind) for kind in KINDS]
    digest = F.sha2(written("base").cast("binary"), 256).alias("base_sha256")
    return found.select("doc_id", *counts, digest, written(F.concat("base", "added")).alias("spans"))
