import random
import re

import pytest
from pyspark.sql import functions as F

from flexspark.jobs.entities import KINDS, count_entities, detect_entities, mask_entities


def _luhn(text):
    digits = [int(c) for c in text if c.isdigit()][::-1]
    return sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(digits)) % 10 == 0


def _phone(text):
    return all(part[0] >= "2" and part[1:] != "11" for part in text.split("-")[:2])


def _ssn(text):
    area, group, serial = text.split("-")
    return area not in ("000", "666") and area < "900" and group != "00" and serial != "0000"


CONFIRM = {
    "EMAIL": lambda t: ".." not in t,
    "IP_ADDRESS": lambda t: all(int(x) <= 255 for x in t.split(".")),
    "CREDIT_CARD": lambda t: _luhn(t) and next(c for c in t if c.isdigit()) in "23456",
    "IBAN": lambda t: int("".join(str(int(c, 36)) for c in t[4:] + t[:4])) % 97 == 1,
    "PHONE_NUMBER": _phone,
    "SSN": _ssn,
}


def brute(text, kinds=KINDS):
    found = [(n, m.start(), m.end(), m[0]) for n in kinds for m in re.finditer(KINDS[n].pattern, text) if CONFIRM[n](m[0])]
    return sorted(found, key=lambda e: (e[1], e[0]))


def masked(text, kinds=KINDS):
    for n in kinds:
        text = re.sub(KINDS[n].pattern, lambda m, n=n: f"[{n}]" if CONFIRM[n](m[0]) else m[0], text)
    return text


def _texts():
    rng = random.Random(7)
    number = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    make = [
        lambda: f"{rng.choice(['ann', 'b.c', 'x..y', 'é'])}@mail{rng.randint(1, 9)}.example.{rng.choice(['com', 'c'])}",
        lambda: ".".join(str(rng.randint(0, 300)) for _ in range(rng.choice([3, 4, 4, 5]))),
        lambda: rng.choice(["4111111111111111", "4111 1111 1111 1111", "5500-0055-5555-5559", number(16), number(13), "0" * 16]),
        lambda: rng.choice(["GB82WEST12345698765432", "DE89370400440532013000", "GB83WEST12345698765432", "gb82west12345698765432"]),
        lambda: f"{number(3)}-{number(3)}-{number(4)}",
        lambda: f"{rng.choice(['000', '666', '900', '078', '219'])}-{rng.choice(['00', '05'])}-{rng.choice(['0000', '1120'])}",
        lambda: rng.choice(["word", "é😀", "a_4111111111111111", "x" * 300, "\n"]),
    ]
    return [rng.choice(["", " "]).join(rng.choice(make)() + rng.choice([" ", ", ", "é", ""]) for _ in range(rng.choice([1, 5, 40, 900]))) for _ in range(120)]


def test_entities_equal_brute_force(spark):
    texts = _texts()
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    got = {r["id"]: [tuple(e) for e in r["entities"]] for r in detect_entities(df, "text").collect()}
    assert got == {i: brute(t) for i, t in enumerate(texts)}
    assert all(any(e[0] == n for t in texts for e in brute(t)) for n in KINDS)
    shown = {r["id"]: r["text"] for r in mask_entities(df, "text").collect()}
    assert shown == {i: masked(t) for i, t in enumerate(texts)}
    counts = {r["entity"]: (r["rows"], r["matches"], r["found"]) for r in count_entities(df, ["text"]).collect()}
    assert counts == {n: (len(texts), sum(bool(brute(t, [n])) for t in texts), sum(len(brute(t, [n])) for t in texts)) for n in KINDS}


def test_odd_texts(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "10.0.0.1 " * 20000)], "`odd.id` int, text string")
    rows = detect_entities(df, "text").orderBy("`odd.id`").collect()
    assert rows[0]["entities"] is None and rows[1]["entities"] == []
    spans = rows[2]["entities"]
    assert len(spans) == 20000 and all(e["start"] == 9 * i and e["stop"] == 9 * i + 8 for i, e in enumerate(spans))
    shown = mask_entities(df, "text", ["IP_ADDRESS"], "shown").orderBy("`odd.id`").collect()
    assert [r["shown"] for r in shown] == [None, "", "[IP_ADDRESS] " * 20000] and shown[2]["text"].startswith("10.")
    empty = count_entities(df.where("false"), ["text"], ["EMAIL"]).collect()
    assert [tuple(r) for r in empty] == [("text", "EMAIL", 0, 0, 0)]
    with pytest.raises(ValueError, match="NOBODY"):
        mask_entities(df, "text", ["NOBODY"])


def test_columns_stay_in_the_jvm(spark):
    df = spark.range(1).select(F.lit("a@b.co").alias("text"))
    plan = detect_entities(df, "text")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan
