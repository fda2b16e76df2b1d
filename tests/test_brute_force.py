"""Random skewed actions against plain Python."""

import random
from collections import Counter, defaultdict
from datetime import datetime

import pytest

from clickpulse import schemas
from clickpulse.operators import areas, categories, sessions
from clickpulse.sinks.files import as_delimited
from clickpulse.sources.delimited import parse_lines

TOKENS = ["", " ", "1", "2", " 2", "3", "4", "5", "\t"]


@pytest.fixture(scope="module", params=range(3))
def data(request):
    """A third of the actions belong to one session, one city and one product."""
    pick = random.Random(request.param)
    rows = []
    for _ in range(1500):
        hot = pick.random() < 1 / 3
        session = "hot" if hot else f"s{pick.randrange(150)}"
        time = f"2024-01-{pick.choice([1, 2]):02} {pick.choice([8, 9]):02}:59:{pick.randrange(60):02}"
        lists = ["|".join(pick.choices(TOKENS, k=pick.randrange(4))) for _ in range(4)]
        rows.append(
            (
                time[:10],
                1 if hot else pick.randrange(50),
                session,
                pick.randrange(300),
                time,
                pick.choice(["", "word"]),
                pick.choice(TOKENS) if pick.random() < 0.4 else "",
                "p" if hot else pick.choice(["", "1", "2", "3"]),
                *lists,
                3 if hot else pick.randrange(8),
            )
        )
    return rows


@pytest.fixture
def actions(spark, data):
    return spark.createDataFrame(data, schemas.USER_VISIT_ACTION).repartition(5)


def uses(row):
    """(category, kind) of one action."""
    click, order, pay = row[6], row[8], row[10]
    if click.strip():
        return [(click, 0)]
    for kind, text in ((1, order), (2, pay)):
        if text.strip():
            return [(token, kind) for token in text.split("|") if token.strip()]
    return []


def best(counts, n):
    return sorted(counts.items(), key=lambda item: (-item[1], item[0]))[:n]


def test_categories(actions, data, rows):
    counts = Counter(use for row in data for use in uses(row))
    counted = categories.category_counts(actions)
    assert rows(counted) == sorted(((c, k, n) for (c, k), n in counts.items()), key=repr)

    kinds = defaultdict(dict)
    for (category, kind), n in counts.items():
        kinds[kind][category] = n
    tops = {kind: dict(best(of_kind, 2)) for kind, of_kind in kinds.items()}
    chosen = set().union(*tops.values())
    top = categories.top_categories(counted, 2)
    pivot = [(c, *(tops.get(kind, {}).get(c, 0) for kind in range(3))) for c in chosen]
    assert rows(categories.category_pivot(top)) == sorted(pivot, key=repr)

    per_session = defaultdict(Counter)
    for row in data:
        for use in uses(row):
            if use[0] in chosen:
                per_session[use][row[2]] += 1
    expected = [
        (category, kind, session, n, rank + 1)
        for (category, kind), of_session in per_session.items()
        for rank, (session, n) in enumerate(best(of_session, 3))
    ]
    session_counts = categories.category_session_counts(actions, top, 2)
    leaders = categories.top_sessions(session_counts, 3)
    assert rows(leaders) == sorted(expected, key=repr)
    ids = {row[2] for row in expected}
    details = categories.session_details(actions, leaders, 2, 3)
    assert rows(details) == sorted((row for row in data if row[2] in ids), key=repr)


def test_sessions(actions, data, rows):
    by_session, by_hour = defaultdict(list), defaultdict(list)
    for row in data:
        at = datetime.fromisoformat(row[4])
        by_session[row[2]].append(at)
        by_hour[row[4][:10], at.hour, row[2]].append(at)
    lengths = {s: int((max(ats) - min(ats)).total_seconds()) for s, ats in by_session.items()}
    assert rows(sessions.session_lengths(actions)) == sorted(lengths.items(), key=repr)
    spans = [(*key, int((max(a) - min(a)).total_seconds()) * 1000) for key, a in by_hour.items()]
    assert rows(sessions.hourly_session_lengths(actions)) == sorted(spans, key=repr)


def test_areas(spark, actions, data, rows):
    cities = [(c, f"city{c}", "north" if c % 2 else "south", "p") for c in range(7)]
    area = {c: name for c, _, name, _ in cities}
    clicks, in_city = Counter(), defaultdict(Counter)
    for row in data:
        if row[7].strip() and row[12] in area:
            clicks[area[row[12]], row[7]] += 1
            in_city[area[row[12]], row[7]][f"{row[12]}:city{row[12]}"] += 1
    city_clicks = areas.city_product_clicks(actions, spark.createDataFrame(cities, schemas.CITY_INFO))
    top = areas.top_area_products_with_cities(city_clicks, 2)
    expected = []
    for name in ("north", "south"):
        ranked = best({p: n for (a, p), n in clicks.items() if a == name}, 2)
        for rank, (product, n) in enumerate(ranked):
            infos = ",".join(f"{c}:{k}" for c, k in best(in_city[name, product], 99))
            expected.append((name, product, n, infos, rank + 1))
    columns = ["area", "click_product_id", "click_count", "city_infos", "rn"]
    assert rows(top, *columns) == sorted(expected, key=repr)


def test_text_round_trip(actions, data, rows):
    parsed = parse_lines(as_delimited(actions), schemas.USER_VISIT_ACTION, ",")
    assert rows(parsed) == sorted(data, key=repr)
