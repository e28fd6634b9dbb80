"""Places of pattern matches in a text, with DataFrame functions only, in time that grows with the text and not with its square."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from loanmill.functions.text import given

SPAN = "array<struct<start:int,end:int,text:string>>"
_NUMBERS = "array<int>"
# An array grows by copying, so running values are collected in blocks of this size and the blocks put together.
BLOCK = 128
# Texts are cut into parts of so many code points where many places in them are looked up.
PART = 1_024


def _no_numbers() -> Column:
    return F.coalesce(F.lit(None).cast(_NUMBERS), F.array().cast(_NUMBERS))


def scan(items: Column, value: Callable, combine: Callable) -> Column:
    """For each item, the values of all items before it combined, starting from 0: running sums or maxima, as array of int."""

    def before(block: Column, start: Column) -> Column:
        def step(state: Column, item: Column) -> Column:
            return F.struct(combine(state["now"], value(item)).alias("now"), F.concat(state["out"], F.array(state["now"])).alias("out"))

        return F.aggregate(block, F.struct(start.alias("now"), _no_numbers().alias("out")), step, lambda state: state["out"])

    def by_block(items: Column) -> Column:
        numbers = F.sequence(F.lit(0), F.greatest(F.floor((F.size(items) - 1) / BLOCK), F.lit(0)).cast("int"))
        blocks = F.transform(numbers, lambda k: F.slice(items, k * BLOCK + 1, F.lit(BLOCK)))

        def joined(blocks: Column) -> Column:
            whole = F.transform(blocks, lambda block: F.aggregate(block, F.lit(0), lambda total, item: combine(total, value(item))))
            starts = given(whole, lambda whole: before_blocks(whole))
            return given(starts, lambda starts: F.flatten(F.transform(blocks, lambda block, k: before(block, F.coalesce(F.get(starts, k), F.lit(0))))))

        def before_blocks(whole: Column) -> Column:
            def step(state: Column, block: Column) -> Column:
                return F.struct(combine(state["now"], block).alias("now"), F.concat(state["out"], F.array(state["now"])).alias("out"))

            return F.aggregate(whole, F.struct(F.lit(0).alias("now"), _no_numbers().alias("out")), step, lambda state: state["out"])

        return given(blocks, joined)

    return given(items, by_block)


def find_between(text: Column, pattern: str | Column) -> Column:
    """Leftmost non-overlapping matches as (`start`, `end`, `text`, `before`, `after`): places in code points, end exclusive,
    and the text between a match and its neighbours.

    The matches and what lies between them cover the text, so the places are running sums of lengths. Both are
    worked out once. The pattern must not match empty text.
    """
    regex = F.lit(pattern) if isinstance(pattern, str) else pattern

    def placed(pairs: Column) -> Column:
        starts = scan(pairs, lambda p: F.length(p["before"]) + F.length(p["text"]), lambda a, b: a + b)

        def shown(starts: Column) -> Column:
            def one(p: Column, k: Column) -> Column:
                start = F.get(starts, k) + F.length(p["before"])
                return F.struct(
                    start.alias("start"), (start + F.length(p["text"])).alias("end"), p["text"].alias("text"), p["before"].alias("before"), p["after"].alias("after")
                )

            return F.transform(pairs, one)

        return given(starts, shown)

    def paired(hits: Column, gaps: Column) -> Column:
        zipped = F.arrays_zip(hits.alias("text"), F.slice(gaps, F.lit(1), F.size(hits)).alias("before"), F.slice(gaps, F.lit(2), F.size(hits)).alias("after"))
        return given(zipped, placed)

    hits, gaps = F.regexp_extract_all(text, regex, F.lit(0)), F.split(text, regex, -1)
    return given(hits, lambda hits: given(gaps, lambda gaps: paired(hits, gaps)))


def find(text: Column, pattern: str | Column) -> Column:
    """The matches of `find_between` as (`start`, `end`, `text`)."""
    plain = lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["text"].alias("text"))
    return F.transform(find_between(text, pattern), plain)


def replaced(text: Column, spans: Column, shown: Callable) -> Column:
    """The text with each of the `spans` (`start`, `end`, in order of start) replaced by `shown(span)`; a span that
    begins inside of an earlier one is left out."""

    def cut(parts: Column, start: Column, size: Column) -> Column:
        first = F.floor(start / PART).cast("int")
        count = F.floor((start + size) / PART).cast("int") - first + 1
        return F.substring(F.array_join(F.slice(parts, first + 1, count), ""), start - first * PART + 1, size)

    def pieces(spans: Column, parts: Column, filled: Column) -> Column:
        def piece(s: Column, k: Column) -> Column:
            at = F.get(filled, k)
            return F.when(s["start"] >= at, F.concat(cut(parts, at, s["start"] - at), shown(s))).otherwise(F.lit(""))

        end = F.greatest(F.get(filled, F.size(filled) - 1), F.element_at(spans, -1)["end"])
        last = given(end, lambda end: cut(parts, end, F.greatest(F.length(text) - end, F.lit(0))))
        return F.concat(F.array_join(F.transform(spans, piece), ""), last)

    def with_parts(spans: Column) -> Column:
        filled = scan(spans, lambda s: s["end"], lambda a, b: F.greatest(a, b))
        parts = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PART}}}"), F.lit(0))
        return given(filled, lambda filled: given(parts, lambda parts: pieces(spans, parts, filled)))

    return given(spans, lambda spans: F.when(F.size(spans) > 0, with_parts(spans)).otherwise(text))


def apart(items: Column, others: Column) -> Column:
    """For each of the `items`, whether it overlaps none of the `others`, as array of boolean. Both are arrays of structs with
    `start` and `end`; the items come in order of start.

    One sorted list of both is passed in either direction: an item is apart if what begins before it ends by its
    start, and what begins after it does so from its end on.
    """
    far = (1 << 31) - 1

    def flags(events: Column) -> Column:
        ends = scan(events, lambda e: F.when(e["item"], 0).otherwise(e["end"]), lambda a, b: F.greatest(a, b))
        nearest = scan(F.reverse(events), lambda e: F.when(e["item"], 0).otherwise(far - e["start"]), lambda a, b: F.greatest(a, b))

        def both(ends: Column, begins: Column) -> Column:
            free = lambda e, k: (F.get(ends, k) <= e["start"]) & (far - F.get(begins, k) >= e["end"])
            judged = F.transform(events, lambda e, k: F.struct(e["item"].alias("item"), free(e, k).alias("free")))
            return F.transform(F.filter(judged, lambda j: j["item"]), lambda j: j["free"])

        return given(ends, lambda ends: given(F.reverse(nearest), lambda begins: both(ends, begins)))

    event = lambda is_item: lambda s: F.struct(s["start"].alias("start"), F.lit(is_item).alias("item"), s["end"].alias("end"))
    return given(F.array_sort(F.concat(F.transform(others, event(False)), F.transform(items, event(True)))), flags)
