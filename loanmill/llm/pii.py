"""Personal data: fixed patterns, and bootstrapped contextual extraction of identifiers that the patterns miss.

What the fixed patterns find are the seeds. The words around seeds make lexical patterns; a pattern is as sure as the share of its
instances that are known, and instances of sure patterns become known in turn, for some rounds (Riloff and Jones, 1999).
Scores spread over the graph of distinct patterns and instances, not over their occurrences. All steps are column expressions,
grouped sums and equi-joins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanmill.functions.text import given
from loanmill.llm import spans
from loanmill.llm.common import fresh, row_key, staged

KINDS = ("email", "ip", "card", "phone")
# The fixed patterns. Possessive repeats and the look-behind keep them linear on long runs without changing what they find.
_LOCAL = "A-Za-z0-9._%+-"
EMAIL = rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9]){12,}+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
# What may be an identifier: a phone or card as above, or a word with a digit or an @.
UNIT = rf"{PHONE}|{CARD}|(?<!\S)[^\s0-9@]*+[0-9@]\S*+"

ROUNDS = 3
# Least number of known instances of a pattern, least share of them among all its instances, and least score of a new instance.
SUPPORT = 3
PATTERN_SHARE = 0.6
INSTANCE_SCORE = 0.8

_SPANS = "array<struct<kind:int,start:int,end:int>>"


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether the last digit checks: from the right, each second digit counts double, with nine taken off above nine."""
    reverse = F.reverse(digits)

    def add(total: Column, place: Column) -> Column:
        digit = F.substring(reverse, place, F.lit(1)).cast("int")
        twice = digit * 2
        return total + F.when(place % 2 == 1, digit).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def _is_card(text: Column) -> Column:
    digits = _digits(text)
    return F.when(F.length(digits).between(13, 19), _luhn(digits)).otherwise(F.lit(False))


def _is_ip(text: Column) -> Column:
    part = lambda p: F.regexp_replace(p, "^0+(?=.)", "")
    return F.forall(F.split(text, r"\."), lambda p: F.when(F.length(part(p)) <= 3, part(p).cast("int") <= 255).otherwise(F.lit(False)))


def _is_phone(text: Column) -> Column:
    return F.length(_digits(text)).between(9, 15)


def base_spans(text: Column) -> Column:
    """What the fixed patterns find, by kind in the order of `KINDS`, then by start."""
    has_digit = text.rlike("[0-9]")
    checks = (
        (EMAIL, F.contains(text, F.lit("@")), None), (IP, has_digit, _is_ip), (CARD, has_digit, _is_card), (PHONE, F.contains(text, F.lit("+")), _is_phone),
    )
    lists = []
    for kind, (pattern, possible, check) in enumerate(checks):
        found = spans.find(text, pattern)
        valid = found if check is None else F.filter(found, lambda s: check(s["text"]))  # noqa: B023
        shown = F.transform(valid, lambda s: F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end")))  # noqa: B023
        lists.append(F.when(possible, shown).otherwise(F.array().cast(_SPANS)))
    return F.concat(*lists)


def _seed_kind(text: Column) -> Column:
    """Kind of a unit that a fixed pattern covers, else NULL."""
    return (
        F.when(text.rlike(EMAIL), F.lit(0))
        .when(text.rlike(rf"^{IP}$"), F.when(_is_ip(text), F.lit(1)))
        .when(text.rlike(rf"^{CARD}$") & _is_card(text), F.lit(2))
        .when(text.rlike(rf"^{PHONE}$") & _is_phone(text), F.lit(3))
    )


def _may_be(kind: Column, text: Column) -> Column:
    """Whether a unit has the looks of a kind: an address sign, dotted numbers, or enough digits."""
    return (
        F.when(kind == 0, F.contains(text, F.lit("@"))).when(kind == 1, text.rlike(r"[0-9a-fA-F]+[.:][0-9a-fA-F]*[.:][0-9a-fA-F]"))
        .when(kind == 2, F.length(_digits(text)) >= 8).otherwise(F.length(_digits(text)) >= 6)
    )


def units(text: Column) -> Column:
    """Possible identifiers of a text: (`start`, `end`, `text`, `patterns`), the patterns being the two words before, and the words
    on both sides. Punctuation around an identifier is not part of it."""
    word = lambda gap, k: F.element_at(F.split(F.lower(F.trim(F.regexp_replace(gap, r"\s+", " "))), " "), k)

    def unit(span: Column) -> Column:
        words = F.split(F.lower(F.trim(F.regexp_replace(F.right(span["before"], F.lit(200)), r"\s+", " "))), " ")
        following = word(F.left(span["after"], F.lit(200)), 1)
        lead = F.length(span["text"]) - F.length(F.regexp_replace(span["text"], r"^[^0-9A-Za-z+@]+", ""))
        core = F.regexp_replace(span["text"], r"^[^0-9A-Za-z+@]+|[^0-9A-Za-z]+$", "")

        def shown(words: Column, core: Column) -> Column:
            start, last = span["start"] + lead, F.element_at(words, -1)
            second = F.when(F.size(words) > 1, F.element_at(words, -2)).otherwise(F.lit("#"))
            patterns = F.array(F.concat_ws(" ", F.lit("<"), second, last), F.concat_ws(" ", F.lit("<>"), last, following))
            return F.struct(start.alias("start"), (start + F.length(core)).alias("end"), core.alias("text"), patterns.alias("patterns"))

        return given(words, lambda words: given(core, lambda core: shown(words, core)))

    kind = "array<struct<start:int,end:int,text:string,patterns:array<string>>>"
    found = F.transform(spans.find_between(text, UNIT), unit)
    return F.when(text.rlike("[0-9@]"), F.filter(found, lambda u: F.length(u["text"]) > 2)).otherwise(F.array().cast(kind))


def bootstrap(edges: DataFrame, seeds: DataFrame) -> DataFrame:
    """(`instance`, `kind`, `score`) of the instances that sure patterns reveal, without the seeds.

    `edges` are distinct (`pattern`, `instance`), `seeds` (`instance`, `kind`).
    """
    known = seeds.withColumn("score", F.lit(1.0))
    new = None
    for _ in range(ROUNDS):
        scored = edges.join(known, "instance", "left")
        sums = [F.sum(F.when(F.col("kind") == k, F.col("score")).otherwise(0.0)).alias(f"sum{k}") for k in range(len(KINDS))]
        totals = scored.groupBy("pattern").agg(F.countDistinct("instance").alias("n"), *sums)
        best = F.array_max(F.array(*[F.struct(F.col(f"sum{k}").alias("sum"), F.lit(-k).alias("order")) for k in range(len(KINDS))]))
        sure = totals.withColumn("best", best).select(
            "pattern", (-F.col("best.order")).alias("kind"), F.col("best.sum").alias("sum"), (F.col("best.sum") / F.col("n")).alias("share")
        ).filter((F.col("sum") >= SUPPORT) & (F.col("share") >= PATTERN_SHARE))
        patterns = staged(sure, "sure-patterns")
        doubt = F.sum(F.log(F.greatest(F.lit(1.0) - F.col("share"), F.lit(1e-6))))
        reached = edges.join(patterns, "pattern").groupBy("instance", "kind").agg((F.lit(1.0) - F.exp(doubt)).alias("score"))
        fresh = reached.filter(F.col("score") >= INSTANCE_SCORE).join(seeds.select("instance").distinct(), "instance", "left_anti")
        # An instance has one kind: that of the higher score, then the earlier.
        one = fresh.groupBy("instance").agg(F.max(F.struct("score", (-F.col("kind")).alias("order"))).alias("b"))
        new = staged(one.select("instance", (-F.col("b.order")).alias("kind"), F.col("b.score").alias("score")), "new-instances")
        known = seeds.withColumn("score", F.lit(1.0)).unionByName(new)
    return new


def extract(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(`id_col`, `row`, `base`, `added`) per row of `docs`, `row` being its key: spans (`kind`, `start`, `end`) in code points; `kind` indexes `KINDS`.

    `base` is what the fixed patterns find, `added` what the contexts reveal outside of it. Defined cases: a NULL or empty text has
    no spans. Each row gets a row; rows of equal id and text get equal spans. NULL ids are carried along, other columns are not
    read. Instances are compared without regard to case.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))

    def free_units(base: Column, found: Column) -> Column:
        return given(spans.apart(found, base), lambda free: F.transform(found, lambda u, k: F.struct(
            u["start"].alias("start"), u["end"].alias("end"), u["text"].alias("text"), u["patterns"].alias("patterns"), F.get(free, k).alias("free")
        )))

    def scan(base: Column) -> Column:
        return given(units(F.col("_text")), lambda found: F.struct(base.alias("base"), free_units(base, found).alias("units")))

    scanned = docs.select(F.col(id_col).alias("id"), row_key(id_col, text).alias("row"), text.alias("_text")).select(
        "id", "row", given(base_spans(F.col("_text")), scan).alias("found")
    )
    table = staged(scanned.select("id", "row", "found.base", "found.units"), "pii-scan")
    seen = table.filter(F.size("units") > 0).select("row", F.explode("units").alias("unit"))
    occurrences = seen.select(
        "row", F.col("unit.start").alias("start"), F.col("unit.end").alias("end"), F.col("unit.text").alias("text"),
        F.lower("unit.text").alias("instance"), F.col("unit.patterns").alias("patterns"), F.col("unit.free").alias("free"),
    )
    edges = staged(occurrences.select(F.explode("patterns").alias("pattern"), "instance").distinct(), "edges")
    spelled = occurrences.groupBy("instance").agg(F.min("text").alias("text"))
    seeds = staged(spelled.select("instance", _seed_kind(F.col("text")).alias("kind")).filter("kind is not null"), "seeds")
    new = bootstrap(edges, seeds)
    added = occurrences.filter("free").join(new, "instance").filter(_may_be(F.col("kind"), F.col("text"))).groupBy("row").agg(
        F.collect_set(F.struct("kind", "start", "end")).alias("added")
    )
    return table.join(added, "row", "left").select(
        F.col("id").alias(id_col), "row", "base", F.coalesce(F.array_sort("added"), F.array().cast(_SPANS)).alias("added")
    )


def mask(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` with every span replaced by its kind in angle brackets; all columns stay, and a NULL text stays NULL.

    Overlapping spans are replaced once, by the kind of the one that begins first, then of the longer. Only the
    added spans, which are few, are joined; the fixed patterns are matched again where the text is.
    """
    text = F.col(text_col)
    row, more, every, out = fresh(docs, "_row", "_added", "_every", "_masked")
    added = extract(docs, id_col, text_col).filter(F.size("added") > 0).groupBy(F.col("row").alias(row)).agg(F.first("added").alias(more))
    joined = docs.join(staged(added, "added-spans"), row_key(id_col, F.coalesce(text, F.lit(""))) == F.col(row), "left")
    spans_of = F.concat(base_spans(F.coalesce(text, F.lit(""))), F.coalesce(more, F.array().cast(_SPANS)))
    order = F.array_sort(F.transform(spans_of, lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("before"), s["kind"].alias("kind"))))
    names = F.array(*[F.lit(f"<{k}>") for k in KINDS])
    ends = F.transform(order, lambda s: F.struct(s["start"].alias("start"), (-s["before"]).alias("end"), s["kind"].alias("kind")))
    masked = spans.replaced(text, F.col(every), lambda s: F.element_at(names, s["kind"] + 1))
    done = joined.withColumn(every, ends).withColumn(out, masked)
    return done.select(*[F.col(out).alias(c) if c == text_col else F.col(c) for c in docs.columns])


def op1_pii(spark, sf_dir: str) -> DataFrame:
    """Personal data in all documents."""
    found = extract(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    name = lambda s: F.concat_ws(":", F.element_at(F.array(*map(F.lit, KINDS)), s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))
    joined = lambda spans_: F.array_join(F.transform(spans_, name), ",")
    many = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    counts = [many(k).alias(f"n_{kind}") for k, kind in enumerate(KINDS)]
    return found.select(
        "doc_id", *counts, F.sha2(joined(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        joined(F.array_sort(F.concat("base", "added"))).alias("spans"), F.size("added").cast("long").alias("n_added"),
    )
