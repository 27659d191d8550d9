"""Personal data in text columns: candidates by pattern, confirmed by checksums and number ranges, as spans, counts or masks.

Everything is a column expression over one row, so a text of any length needs no shuffle and no Python.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flexspark.plans.paths import top

FOUND = "array<struct<entity:string,start:int,stop:int,value:string>>"
_BLOCK = 256  # lengths summed at once: keeps running sums of n matches far from n * n


class Kind(NamedTuple):
    """A kind of entity: the pattern of its candidates and what confirms one (a text column to a boolean column)."""

    pattern: str
    confirm: Callable[[Column], Column]


def _let(value: Column, f: Callable[[Column], Column]) -> Column:
    """``f(value)``, with the value computed once however often ``f`` names it."""
    return F.transform(F.array(value), f)[0]


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _number(text: Column, start: int, length: int) -> Column:
    return F.substring(text, start, length).cast("int")


def luhn(text: Column) -> Column:
    """Whether the digits of a text sum to a multiple of ten, every second one from the right doubled."""

    def summed(digits: Column) -> Column:
        weighed = F.transform(
            F.split(F.reverse(digits), "(?<=.)(?=.)"),
            lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(d.cast("int") * 2 - F.when(d >= "5", 9).otherwise(0)),
        )
        return F.aggregate(weighed, F.lit(0), lambda a, x: a + x) % 10 == 0

    return _let(_digits(text), summed)


def mod97(text: Column) -> Column:
    """Whether an account number, its first four characters moved to the end and letters read as 10 to 35, leaves 1 modulo 97."""
    moved = F.concat(F.substring(text, 5, 64), F.substring(text, 1, 4))
    values = F.transform(F.split(moved, "(?<=.)(?=.)"), lambda c: F.ascii(c) - F.when(c >= "A", 55).otherwise(48))
    return F.aggregate(values, F.lit(0), lambda a, v: (a * F.when(v >= 10, 100).otherwise(10) + v) % 97) == 1


def octets(text: Column) -> Column:
    """Whether all four numbers of an address are at most 255."""
    return F.forall(F.split(text, "[.]"), lambda x: x.cast("int") <= 255)


def _card(text: Column) -> Column:
    return luhn(text) & _digits(text).rlike("^[2-6]")


def _ssn(text: Column) -> Column:
    """Area numbers 000, 666 and from 900, group 00 and serial 0000 are never given out."""
    area = _number(text, 1, 3)
    return (area > 0) & (area != 666) & (area < 900) & (_number(text, 5, 2) > 0) & (_number(text, 8, 4) > 0)


def _phone(text: Column) -> Column:
    """Area and exchange start with 2 to 9 and don't end in 11."""
    return F.forall(F.array(F.substring(text, 1, 3), F.substring(text, 5, 3)), lambda x: x.rlike("^[2-9](?!11)"))


_START, _END = "(?<![0-9A-Za-z_])", "(?![0-9A-Za-z_])"

# Shapes of personal data. Repeats are bounded, so that a long run of letters or digits costs no more than its length.
KINDS: dict[str, Kind] = {
    "EMAIL": Kind(r"[A-Za-z0-9._%+-]{1,64}@[A-Za-z0-9.-]{1,189}\.[A-Za-z]{2,63}", lambda t: ~t.contains("..")),
    "IP_ADDRESS": Kind(_START + r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}" + _END, octets),
    "CREDIT_CARD": Kind(_START + r"[0-9](?:[ -]?[0-9]){12,18}" + _END, _card),
    "IBAN": Kind(_START + r"[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}" + _END, mod97),
    "PHONE_NUMBER": Kind(_START + r"[0-9]{3}-[0-9]{3}-[0-9]{4}" + _END, _phone),
    "SSN": Kind(_START + r"[0-9]{3}-[0-9]{2}-[0-9]{4}" + _END, _ssn),
}


def _cut(text: Column, kind: Kind) -> Column:
    """The candidates of a kind (``hits``) and the texts around them (``gaps``, one more)."""
    return F.struct(F.split(text, kind.pattern, -1).alias("gaps"), F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0)).alias("hits"))


def _running(lengths: Column) -> Column:
    """Sums of the lengths before each of them."""
    add = lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x))
    block = lambda b: F.slice(lengths, b * _BLOCK + 1, F.lit(_BLOCK))
    blocks = F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / _BLOCK).cast("int"))
    totals = F.transform(blocks, lambda b: F.aggregate(block(b), F.lit(0), lambda a, x: a + x))
    whole = lambda before: F.flatten(
        F.transform(blocks, lambda b: _let(F.aggregate(block(b), F.array(before[b]), add), lambda sums: F.slice(sums, F.lit(1), F.size(sums) - 1)))
    )
    return F.when(F.size(lengths) > 0, _let(F.aggregate(totals, F.array(F.lit(0)), add), whole)).otherwise(F.array().cast("array<int>"))


def _spans(text: Column, name: str, kind: Kind) -> Column:
    """Confirmed candidates of a kind with their places in the text, in code points, the end exclusive."""

    def placed(cut: Column) -> Column:
        lengths = F.zip_with(F.slice(cut["gaps"], F.lit(1), F.size(cut["hits"])), cut["hits"], lambda g, h: F.length(g) + F.length(h))
        before = _let(lengths, _running)
        both = F.arrays_zip(F.slice(cut["gaps"], F.lit(1), F.size(cut["hits"])).alias("gap"), cut["hits"].alias("hit"), before.alias("before"))
        start = lambda z: z["before"] + F.length(z["gap"])
        entry = lambda z: F.struct(
            F.lit(name).alias("entity"), start(z).alias("start"), (start(z) + F.length(z["hit"])).alias("stop"), z["hit"].alias("value")
        )
        return F.transform(F.filter(both, lambda z: kind.confirm(z["hit"])), entry)

    return _let(_cut(text, kind), placed)


def _masked(text: Column, name: str, kind: Kind) -> Column:
    """The text with confirmed candidates of a kind replaced by ``[NAME]``."""
    shown = lambda cut: F.array_join(
        F.zip_with(cut["gaps"], cut["hits"], lambda g, h: F.concat(g, F.when(h.isNull(), "").when(kind.confirm(h), f"[{name}]").otherwise(h))), ""
    )
    return _let(_cut(text, kind), shown)


def _chosen(kinds: Iterable[str] | dict[str, Kind] | None) -> dict[str, Kind]:
    if isinstance(kinds, dict):
        return kinds
    unknown = [k for k in kinds or () if k not in KINDS]
    if unknown:
        raise ValueError(f"unknown entities {', '.join(unknown)}")
    return {k: KINDS[k] for k in kinds} if kinds else KINDS


def detect_entities(df: DataFrame, column: str, kinds: Iterable[str] | dict[str, Kind] | None = None, output: str = "entities") -> DataFrame:
    """The frame with an array of (entity, start, stop, value) for every confirmed entity of a text column.

    Sorted by start, then entity; places are code points, the end exclusive. Matches of one kind don't overlap, those of different kinds may.
    Null texts have a null array, texts without entities an empty one.
    """
    found = F.flatten(F.array(*[_spans(top(column), n, k) for n, k in _chosen(kinds).items()]))
    first = lambda a, b: F.when(a < b, -1).when(a > b, 1).otherwise(0)
    order = lambda a, b: F.when(a["start"] != b["start"], first(a["start"], b["start"])).otherwise(first(a["entity"], b["entity"]))
    return df.withColumn(output, F.array_sort(found, order).cast(FOUND))


def mask_entities(df: DataFrame, column: str, kinds: Iterable[str] | dict[str, Kind] | None = None, output: str | None = None) -> DataFrame:
    """The frame with every confirmed entity of a text column replaced by ``[ENTITY]``, in ``output`` (the column itself by default).

    Kinds are masked one after the other, in their order; what an earlier one replaced is no candidate of later ones.
    """
    output = output or column
    df = df.withColumn(output, top(column))
    for name, kind in _chosen(kinds).items():
        df = df.withColumn(output, _masked(top(output), name, kind))
    return df


def count_entities(df: DataFrame, columns: Iterable[str], kinds: Iterable[str] | dict[str, Kind] | None = None) -> DataFrame:
    """``column, entity, rows, matches, found``: all rows, those that hold a confirmed entity, and how many they hold; one pass."""
    chosen, columns = _chosen(kinds), list(columns)
    pairs = [(c, n) for c in columns for n in chosen]
    held = lambda c, kind: F.size(F.filter(F.regexp_extract_all(top(c), F.lit(kind.pattern), F.lit(0)), kind.confirm))
    counted = df.select(*[held(c, chosen[n]).alias(f"c{i}") for i, (c, n) in enumerate(pairs)])
    sums = [F.sum(F.greatest(F.col(f"c{i}"), F.lit(0))).alias(f"f{i}") for i in range(len(pairs))]
    one = counted.agg(F.count("*").alias("n"), *[F.count_if(F.col(f"c{i}") > 0).alias(f"m{i}") for i in range(len(pairs))], *sums)
    entry = lambda i, c, n: F.struct(
        F.lit(c).alias("column"), F.lit(n).alias("entity"), F.col("n").alias("rows"), F.col(f"m{i}").alias("matches"), F.coalesce(F.col(f"f{i}"), F.lit(0)).alias("found")
    )
    return one.select(F.inline(F.array(*[entry(i, c, n) for i, (c, n) in enumerate(pairs)])))
