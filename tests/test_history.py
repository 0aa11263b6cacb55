"""Type 2 history against a sequential reading of the same changes."""

from __future__ import annotations

import datetime as dt
import random

import pytest

from shelfstar.operators.scd2 import scd2_apply
from tests.conftest import rows

D = dt.date
OPEN = D(9999, 12, 31)
DIM = (
    "key bigint, id string, price int, status string, title string, "
    "effective_date date, expiration_date date, curr_ind string"
)


def one_by_one(dim, changes, titles, floor):
    """Apply the changes one after the other."""
    table = [dict(r) for r in dim]
    for c in sorted(changes, key=lambda c: (c["id"], c["effective_date"], c["seq"])):
        current = next((r for r in table if r["id"] == c["id"] and r["curr_ind"] == "Y"), None)
        fresh = dict(
            id=c["id"], price=c["price"], status=c["status"], expiration_date=OPEN,
            curr_ind="Y" if c["active"] else "N",
        )
        if current is None:
            if c["id"] in titles:
                table.append(fresh | dict(title=titles[c["id"]], effective_date=c["first_effective"]))
            continue
        same = current["price"] == c["price"] and (current["status"] or "").upper() == (c["status"] or "").upper()
        if c["active"] and same:
            continue
        before = c["effective_date"] - dt.timedelta(days=1)
        current["curr_ind"] = "N"
        if floor == "effective":
            current["expiration_date"] = max(before, current["effective_date"])
        else:
            current["expiration_date"] = min(before, current["expiration_date"])
        if c["active"]:
            table.append(fresh | dict(title=current["title"], effective_date=c["effective_date"]))
    return sorted(
        tuple(str(r[k]) for k in ("id", "price", "status", "title", "effective_date", "expiration_date", "curr_ind"))
        for r in table
    )


@pytest.mark.parametrize("floor", ["before", "effective"])
@pytest.mark.parametrize("seed", [1, 2])
def test_batch_equals_one_by_one(spark, floor, seed):
    rng = random.Random(seed)
    ids = [f"b{i}" for i in range(12)]
    dim = [
        dict(key=100001 + i, id=k, price=10, status="AVAILABLE", title=f"t{k}",
             effective_date=D(2020, 1, 1), expiration_date=OPEN, curr_ind="Y")
        for i, k in enumerate(ids[:8])
    ]
    titles = {k: f"t{k}" for k in ids[:11]}
    changes = []
    for i in range(150):
        k = "b0" if i % 3 == 0 else rng.choice(ids)
        day = D(2020, 2, 1) + dt.timedelta(days=rng.randrange(100))
        changes.append(
            dict(id=k, price=rng.choice([10, 11, None]), status=rng.choice(["available", "LOST", None]),
                 effective_date=day, seq=i, active=rng.random() > 0.15, first_effective=D(2019, 5, 5))
        )
    dim_df = spark.createDataFrame([tuple(r.values()) for r in dim], DIM)
    change_df = spark.createDataFrame(
        [tuple(c.values()) for c in changes],
        "id string, price int, status string, effective_date date, seq int, active boolean, first_effective date",
    )
    source = spark.createDataFrame(list(titles.items()), "id string, title string")
    got = scd2_apply(
        dim_df, change_df, id_col="id", key_col="key", tracked=["price", "status"],
        inherit=["title"], source=source, close_floor=floor,
    )
    out = [r.asDict() for r in got.collect()]
    have = sorted(
        tuple(str(r[k]) for k in ("id", "price", "status", "title", "effective_date", "expiration_date", "curr_ind"))
        for r in out
    )
    assert have == one_by_one(dim, changes, titles, floor)
    keys = [r["key"] for r in out]
    assert sorted(keys) == list(range(100001, 100001 + len(keys)))
    current = [r["id"] for r in out if r["curr_ind"] == "Y"]
    assert len(current) == len(set(current))


def test_unchanged_input_changes_nothing(spark):
    dim = spark.createDataFrame([(100001, "a", 5, "X", "t", D(2020, 1, 1), OPEN, "Y")], DIM)
    same = spark.createDataFrame([("a", 5, "x", D(2021, 1, 1))], "id string, price int, status string, effective_date date")
    got = scd2_apply(dim, same, id_col="id", key_col="key", tracked=["price", "status"], inherit=["title"],
                     source=spark.createDataFrame([("a", "t")], "id string, title string"))
    assert rows(got) == rows(dim)
