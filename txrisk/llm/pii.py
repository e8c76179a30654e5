"""Personal data: patterns propose spans, checks confirm them, words nearby adjust their score.

Cutting a text at all matches of a pattern gives what lies between them, so the places of
matches are running sums of lengths, in code points.  Matches and their neighbourhood are rows from there on:
few, whatever the text is like, and the sum over the matches of a text is a window that
streams.

Context is looked for before and after a match.  Matches of a kind with at most ``NEARBY`` code points
between them are one list: what is said near one of them is said of all.

Kinds: ``email``, ``ip`` (parts up to 255), ``card`` (14 to 19 digits, Luhn), ``phone`` (10 to 15 digits): these
always count; and ``iban`` (mod 97) and ``ssn`` (three, two and four digits), which count if their score with the
context reaches ``LEAST_SCORE``.  An ``iban`` is proposed by its first four characters alone; of what follows, all
lengths that end a word are checked, that of its country first, so neither what stands behind an
account number nor a look-alike before it hides it.  The patterns are written so that no text makes them go back over what they
have read: possessive, and only where the run they begin with begins.

Null texts are empty and have no spans.  Equal rows give equal results, as many as there are; rows
without an id are rows like others.  An empty table gives an empty result; other columns are
carried by the filter and not read by the spans.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txrisk.llm.common import free_name

LEAST_SCORE = 0.5
#: code points before and after a match that are looked at for context
NEARBY = 48
#: letters and digits of an account number after its first four characters, at least and at most
LEAST_IBAN, MOST_IBAN = 11, 30

# Kinds in the order in which they are listed, and what their matches look like.
KINDS = ["email", "ip", "card", "phone", "iban", "ssn"]
BASE = 4
LOCAL = "A-Za-z0-9._%+-"
PATTERNS = {
    "email": rf"(?:(?<![{LOCAL}])|\G)[{LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    # group 1 is what may belong to it, and the letter or digit after that, if one follows at once
    "iban": rf"(?<![A-Za-z0-9])[A-Z]{{2}}[0-9]{{2}}(?=((?:\x20?[A-Z0-9]){{{LEAST_IBAN},{MOST_IBAN}}}+[A-Za-z0-9]?))",
    "ssn": r"(?<![A-Za-z0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![A-Za-z0-9-])",
}
PART = "0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
VALID_IP = rf"^(?:{PART}|0+)(?:\.(?:{PART}|0+)){{3}}$"
CONTEXT = {"iban": "iban|account|konto|bank|cuenta|compte", "ssn": "ssn|social security|sozialversicherung|seguridad social"}
#: lengths of account numbers by country
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
    26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE",
    31: "MT SC", 32: "LC", 33: "RU",
}
MASKS = {kind: f"[{kind.upper()}]" for kind in KINDS}


def luhn(digits: Column) -> Column:
    """Whether a text of digits passes Luhn's check."""
    each = F.transform(F.split(F.reverse(digits), ""), lambda c, i: F.when(i % 2 == 1, (c.cast("int") * 2) % 10 + F.floor(c.cast("int") / 5)).otherwise(c.cast("int")).cast("int"))
    return F.aggregate(each, F.lit(0), lambda s, x: s + F.coalesce(x, F.lit(0))) % 10 == 0


def mod97(iban: Column) -> Column:
    """Whether an account number, without spaces, leaves 1 at division by 97."""
    turned = F.split(F.concat(F.substr(iban, F.lit(5)), F.substring(iban, 1, 4)), "")

    def step(left: Column, c: Column) -> Column:
        value = F.when(c.rlike("[0-9]"), c.cast("int")).when(c.rlike("[A-Z]"), F.ascii(c) - 55)
        return F.when(value.isNull(), left).otherwise((left * F.when(value > 9, 100).otherwise(10) + value) % 97)

    return F.aggregate(turned, F.lit(0), step) == 1


def account_end(head: Column, ahead: Column) -> Column:
    """How many code points of ``ahead`` belong to the account number that begins with ``head``; NULL if it is none."""
    plain = lambda e: F.replace(F.substring(ahead, F.lit(1), e), F.lit(" "), F.lit(""))
    ends_word = lambda e: F.substring(ahead, e, F.lit(1)).rlike("[A-Z0-9]") & ~F.substring(ahead, e + 1, F.lit(1)).rlike("[A-Za-z0-9]")
    ends = F.filter(
        F.sequence(F.lit(LEAST_IBAN), F.greatest(F.char_length(ahead), F.lit(LEAST_IBAN))),
        lambda e: ends_word(e) & F.char_length(plain(e)).between(LEAST_IBAN, MOST_IBAN),
    )
    valid = F.filter(ends, lambda e: mod97(F.concat(head, plain(e))))
    known = F.lit(None).cast("int")
    for length, countries in IBAN_LENGTHS.items():
        known = F.when(F.substring(head, 1, 2).isin(countries.split()), length - 4).otherwise(known)
    return F.coalesce(F.get(F.filter(valid, lambda e: F.char_length(plain(e)) == known), F.lit(0)), F.array_max(valid))


def _with_kind(kind: int):
    def row(r: Column, i: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), i.alias("number"), *[r[c].alias(c) for c in ("gap", "hit", "ahead", "before", "after")])

    return row


def proposals(text: Column) -> Column:
    """All matches of all patterns: kind, number in the text, how much lies before it, the match, and for kinds
    with a context what may belong to it besides and what is before and after."""
    per_kind = []
    for number, kind in enumerate(KINDS):
        pattern = PATTERNS[kind]
        hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
        gaps = F.split(text, pattern, -1)
        nothing = F.transform(hits, lambda hit: F.lit(""))
        lead = F.slice(gaps, F.lit(1), F.greatest(F.size(gaps) - 1, F.lit(0)))
        before, after, ahead = nothing, nothing, nothing
        if kind in CONTEXT:
            before = F.transform(lead, lambda gap: F.right(gap, F.lit(NEARBY)))
            # the rest of an account number is in front of what comes after it
            after = F.transform(F.slice(gaps, F.lit(2), F.greatest(F.size(gaps) - 1, F.lit(0))), lambda gap: F.left(gap, F.lit(NEARBY + 2 * MOST_IBAN)))
        if kind == "iban":
            ahead = F.regexp_extract_all(text, F.lit(pattern), F.lit(1))
        gap = F.transform(lead, lambda gap: F.char_length(gap))
        rows = F.arrays_zip(hits.alias("hit"), gap.alias("gap"), ahead.alias("ahead"), before.alias("before"), after.alias("after"))
        numbered = F.transform(rows, _with_kind(number))
        none = F.array().cast("array<struct<kind:int,number:int,gap:int,hit:string,ahead:string,before:string,after:string>>")
        per_kind.append(F.when(text.rlike(pattern), numbered).otherwise(none))
    return F.concat(*per_kind)


def _is_kind(kind: str) -> Column:
    return F.col("kind") == KINDS.index(kind)


def _scored(placed: DataFrame) -> DataFrame:
    """Add ``score``: 0 for a match that its check rejects."""
    hit = F.col("hit")
    digits = F.regexp_replace(hit, "[^0-9]", "")
    n = F.char_length(digits)
    said = F.lit(False)
    for kind, pattern in CONTEXT.items():
        own = F.lower(F.concat(F.col("before"), F.lit("\n"), F.substring(F.col("after"), F.col("more") + 1, F.lit(NEARBY))))
        said = F.when(_is_kind(kind), own.rlike(pattern)).otherwise(said)
    # a list is as long as its members are near each other; a word near one of them is said of all
    by = Window.partitionBy("doc_id", "key", "kind").orderBy("number")
    apart = F.when(F.col("start") - F.lag("end").over(by) <= NEARBY, 0).otherwise(1)
    listed = placed.withColumn("said", said).withColumn("list", apart)
    listed = listed.withColumn("list", F.sum("list").over(by.rowsBetween(Window.unboundedPreceding, 0)))
    listed = listed.withColumn("said", F.max("said").over(Window.partitionBy("doc_id", "key", "kind", "list")))
    context = F.when(F.col("said"), 0.3).otherwise(0.0)
    score = (
        F.when(_is_kind("email"), 1.0)
        .when(_is_kind("ip"), F.when(hit.rlike(VALID_IP), 1.0).otherwise(0.0))
        .when(_is_kind("card"), F.when(n.between(14, 19), F.when(luhn(digits), 1.0)).otherwise(0.0))
        .when(_is_kind("phone"), F.when(n.between(10, 15), 1.0).otherwise(0.0))
        .when(_is_kind("iban"), F.when(F.col("more") > 0, 0.7 + context).otherwise(0.0))
        .when(_is_kind("ssn"), 0.3 + context)
    )
    # what looks like an account number within a longer one is a part of it
    within = F.max(F.when(F.col("more") > 0, F.col("end"))).over(by.rowsBetween(Window.unboundedPreceding, -1))
    part = _is_kind("iban") & (F.col("end") <= F.coalesce(within, F.lit(0)))
    return listed.withColumn("score", F.when(part, 0.0).otherwise(F.coalesce(score, F.lit(0.0)))).drop("said", "list")


def matches(docs: DataFrame) -> DataFrame:
    """A row for each match of each distinct ``(doc_id, text)``, with its place and score.

    ``kind`` -1 is the row itself.  ``rows`` tells how many equal rows there are.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    plain = docs.select(F.col("doc_id").cast("long"), F.md5(text).alias("key"), text.alias("text"))
    told = ["hit", "ahead", "before", "after"]
    row = F.array(F.struct(F.lit(-1).alias("kind"), F.lit(0).alias("number"), F.lit(0).alias("gap"), *[F.lit("").alias(c) for c in told]))
    each = plain.select("doc_id", "key", F.inline(F.concat(row, proposals(F.col("text")))))
    found = each.groupBy("doc_id", "key", "kind", "number", "gap", *told).agg(F.count(F.lit(1)).alias("rows"))
    upto = Window.partitionBy("doc_id", "key", "kind").orderBy("number").rowsBetween(Window.unboundedPreceding, 0)
    long = F.char_length("hit")
    more = F.when(_is_kind("iban"), F.coalesce(account_end(F.col("hit"), F.col("ahead")), F.lit(0))).otherwise(0)
    placed = found.withColumn("end", F.sum(F.col("gap") + long).over(upto)).withColumn("start", F.col("end") - long)
    placed = placed.withColumn("more", more).withColumn("end", F.col("end") + F.col("more"))
    return _scored(placed).drop("gap", "number", "more", *told)


def spans(docs: DataFrame) -> DataFrame:
    """One row per distinct ``(doc_id, text)``: ``doc_id, key, rows`` (how many there are) and ``spans``,
    an array of ``(start, kind, end, score)`` in order."""
    span = F.when((F.col("kind") >= 0) & (F.col("score") >= LEAST_SCORE), F.struct("start", "kind", "end", "score"))
    return matches(docs).groupBy("doc_id", "key").agg(
        F.max(F.when(F.col("kind") == -1, F.col("rows"))).alias("rows"), F.array_sort(F.collect_list(span)).alias("spans")
    )


def _told(spans_: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans_, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def find(docs: DataFrame) -> DataFrame:
    """``doc_id``, the number of each base kind, ``base_sha256`` and ``spans`` for each row of ``docs``."""
    found = spans(docs)
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == KINDS.index(kind))).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id",
        *map(count, KINDS[:BASE]),
        F.sha2(_told(F.filter("spans", lambda s: s["kind"] < BASE)), 256).alias("base_sha256"),
        _told(F.col("spans")).alias("spans"),
        F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))).alias("copy"),
    ).drop("copy")


def mask(docs: DataFrame) -> DataFrame:
    """``docs`` with the spans in ``text`` masked; texts without any stay as they are.

    Overlapping spans get one mask, that of the first.
    """
    key, id_, cuts, rest = (free_name(docs, n) for n in ("_key", "_id", "_cuts", "_rest"))
    sure = matches(docs).where((F.col("kind") >= 0) & (F.col("score") >= LEAST_SCORE))
    order = Window.partitionBy("doc_id", "key").orderBy("start", "kind")
    covered = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    group = F.sum(F.when(F.col("start") < F.col("covered"), 0).otherwise(1)).over(order.rowsBetween(Window.unboundedPreceding, 0))
    merged = (
        sure.withColumn("covered", covered)
        .withColumn("group", group)
        .groupBy("doc_id", "key", "group")
        .agg(F.min(F.struct("start", "kind")).alias("first"), F.max("end").alias("end"))
        .select("doc_id", "key", "first.start", "first.kind", "end")
    )
    before = F.coalesce(F.lag("end").over(Window.partitionBy("doc_id", "key").orderBy("start")), F.lit(0))
    found = (
        merged.withColumn("before", before)
        .groupBy(F.col("doc_id").alias(id_), F.col("key").alias(key))
        .agg(F.array_sort(F.collect_list(F.struct("start", "before", "kind"))).alias(cuts), F.max("end").alias(rest))
    )
    masks = F.array(*[F.lit(MASKS[k]) for k in KINDS])
    text = F.col("text")
    pieces = F.transform(
        cuts,
        lambda s: F.concat(F.substr(text, (s["before"] + 1).cast("int"), (s["start"] - s["before"]).cast("int")), F.get(masks, s["kind"])),
    )
    new = F.concat(F.array_join(pieces, ""), F.substr(text, (F.col(rest) + 1).cast("int")))
    keyed = docs.withColumn(key, F.md5(F.coalesce(text, F.lit("")))).withColumn(id_, F.col("doc_id").cast("long"))
    same = keyed[id_].eqNullSafe(found[id_]) & (keyed[key] == found[key])
    joined = keyed.join(found, same, "left").drop(found[id_], found[key])
    return joined.withColumn("text", F.when(F.col(cuts).isNull(), text).otherwise(new)).select(*[f"`{c}`" for c in docs.columns])
