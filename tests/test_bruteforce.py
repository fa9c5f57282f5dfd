"""Many small random cases at once, each its own snapshot, against plain Python."""

import random
from collections import defaultdict
from datetime import date, timedelta
from decimal import ROUND_HALF_UP, Decimal

import pytest
from helpers import rows

from pricetide.operators import enrich, gold, silver
from test_enrich import DEAL, DETAIL

CASES = [date(2026, 1, 1) + timedelta(days=n) for n in range(150)]
KEYS = [None, "", "1", "2", "3", "4", "5", "6"]
NAMES = ["a", " a", "a ", "b", "", "\tb", None]


def makers_of(rng):
    return rng.choice([None, [], [rng.choice(NAMES) for _ in range(rng.randint(1, 4))]])


def tags_of(rng):
    tag = lambda: (rng.choice(["1", "2", "x", None]), rng.choice(NAMES))
    return rng.choice([None, [], [tag() for _ in range(rng.randint(1, 4))]])


@pytest.fixture(scope="module")
def case(spark):
    rng = random.Random(7)
    deals = [
        (n, rng.randint(0, 1), rng.choice(KEYS), rng.choice(["s1", "s2", None]),
         rng.choice(["1.005", "2.5", "x", None]), "10", rng.choice(["10", "74.996", "75", None]),
         None, rng.choice(["70", "95", "n/a", None]), day)
        for day in CASES for n in rng.sample(range(40), rng.randint(0, 25))
    ]
    details = [
        (key, rng.choice([True, True, False, None]), rng.choice(NAMES),
         rng.choice([None, (rng.choice(["USD", "BRL", "EUR", None]), 100, 55, 45)]),
         tags_of(rng), makers_of(rng), day)
        for day in CASES for key in KEYS[2:] if rng.random() < 0.8
    ]
    rng.shuffle(deals)
    return (
        deals,
        details,
        spark.createDataFrame(deals, DEAL).repartition(8),
        spark.createDataFrame(details, f"{DETAIL}, snapshot_date date").repartition(8),
    )


def run_loop(deals, details):
    """One pass in arrival order with a set of seen keys."""
    known = {(d[6], d[0]): d for d in details}
    counts, accepted = defaultdict(lambda: [0, 0, 0, 0, 0]), {}
    seen = set()
    for deal in sorted(deals, key=lambda d: (d[9], d[0], d[1])):
        day, key = deal[9], deal[2]
        counts[day][0] += 1
        detail = known.get((day, key))
        if not key:
            counts[day][1] += 1
        elif (day, key) in seen:
            counts[day][2] += 1
        elif not (detail and detail[1]):
            counts[day][3] += 1
        else:
            counts[day][4] += 1
            accepted[day, key] = (deal, detail)
        seen.add((day, key))
    return counts, accepted


def half_up(value, places):
    return float(Decimal(value).quantize(Decimal(1).scaleb(-places), ROUND_HALF_UP))


def mean(values, places):
    known = [Decimal(v) for v in values if v is not None]
    return half_up(sum(known) / len(known), places) if known else None


def clean(name):
    return "DESCONHECIDO" if name is None else name.strip(" ")


def number(text):
    try:
        return text and str(float(text)) and text
    except ValueError:
        return None


ON = ("snapshot_date", "item_id")


def test_audit_equals_the_loop(case):
    deals, details, deal_df, detail_df = case
    counts, _ = run_loop(deals, details)
    got = enrich.rejection_audit(deal_df, detail_df, ON)
    assert rows(got) == sorted(((d, *c) for d, c in counts.items()), key=repr)


def test_records_equal_the_loop(spark, case):
    deals, details, deal_df, detail_df = case
    _, accepted = run_loop(deals, details)
    stores = spark.createDataFrame([("s1", "One")], "store_id string, store_name string")
    got = enrich.enriched_records(deal_df, detail_df, stores, ON).select(
        "snapshot_date", "item_id", "ord1", "ord2", "sale_price", "store"
    )
    label = {"s1": "One", "s2": "Loja s2", None: None}
    expected = [(*k, d[0], d[1], d[4], label[d[3]]) for k, (d, _) in accepted.items()]
    assert rows(got) == sorted(expected, key=repr)


@pytest.fixture(scope="module")
def records(spark, case):
    stores = spark.createDataFrame([("s1", "One")], "store_id string, store_name string")
    return enrich.enriched_records(case[2], case[3], stores, ON)


def ranked(case, names_of):
    """Expected ranking rows; ``names_of`` gives the groups of one detail."""
    groups = defaultdict(list)
    for (day, _), (deal, detail) in run_loop(case[0], case[1])[1].items():
        if detail[3] and detail[3][0] in ("USD", "BRL"):
            for name in names_of(detail):
                groups[day, *name].append(deal)
    out = []
    for group, members in groups.items():
        discounts = [number(d[6]) for d in members]
        known = [Decimal(x) for x in discounts if x is not None]
        out.append(
            (
                *group,
                len(members),
                mean(discounts, 2),
                mean([number(d[4]) for d in members], 2),
                mean([number(d[5]) for d in members], 2),
                half_up(max(known), 2) if known else None,
                mean([number(d[8]) for d in members], 1),
            )
        )
    return sorted(out, key=repr)


def test_maker_ranking_equals_plain_python(case, records):
    expected = ranked(case, lambda d: {(clean(m),) for m in d[5] or []})
    assert rows(gold.rank_makers_of_records(records)) == expected
    tables = gold.rank_makers(silver.silver_items(records), silver.maker_bridge(records))
    assert rows(tables) == expected


def test_tag_ranking_equals_plain_python(case, records):
    def tags(detail):
        names = defaultdict(list)
        for tag_id, name in detail[4] or []:
            names[int(tag_id) if number(tag_id) else None].append(clean(name))
        return {(tag_id, min(found)) for tag_id, found in names.items()}

    expected = ranked(case, tags)
    assert rows(gold.rank_tags_of_records(records)) == expected
    tables = gold.rank_tags(silver.silver_items(records), silver.tag_bridge(records))
    assert rows(tables) == expected
