import random
from collections import Counter

import pytest

from clickpulse.operators import clicks as c

CLICK = "ts_ms bigint, province string, city string, user_id int, ad_id int"
USERS = "user_id int"


@pytest.fixture
def parse(frame, rows):
    return lambda *lines: rows(c.parse_clicks(frame("value string", *((line,) for line in lines))))


@pytest.fixture
def clicks(frame):
    """Clicks from (seconds, user, ad)."""
    return lambda *rows: frame(CLICK, *((int(s * 1000), "p", "c", u, a) for s, u, a in rows))


def test_parse(parse):
    good = (1000, "p", "c", 1, 2)
    assert parse("1000 p c 1 2") == [good]
    assert parse("1000 p c 1 2 extra", " 1000  p c\t 1 \x01 2\r") == [good] * 2
    assert parse("1000 p\tq c 1 2") == [(1000, "p\tq", "c", 1, 2)]
    # A missing field shifts the others.
    assert parse("1000 p c 1", "1000 c 1 2", "", " ", "x p c 1 2") == []
    assert parse("1000 p c 1 bad", "1000 p c 3000000000 2", "1000 p c 1.5 2") == []
    assert parse("1000 p 1 2 3") == [(1000, "p", "1", 2, 3)]


def test_blacklist(clicks, frame, rows):
    kept = c.not_blacklisted(
        clicks((0, 1, 1), (0, 1, 1), (0, 2, 1), (0, 3, 1)), frame(USERS, (1,), (1,), (7,))
    )
    assert kept.columns == c.CLICK_COLUMNS
    assert rows(kept, "user_id") == [(2,), (3,)]


def expected_windows(events, size, slide):
    counts = Counter()
    for second, key in events:
        end = int(second // slide + 1) * slide
        while end - size <= second:
            counts[key, end * 1000] += 1
            end += slide
    return sorted(((k, e, n) for (k, e), n in counts.items()), key=repr)


@pytest.mark.parametrize("size, slide", [(300, 30), (600, 60), (100, 40), (60, 60), (50, 7)])
def test_sliding_counts(clicks, rows, size, slide):
    pick = random.Random(size * slide)
    events = [(pick.randrange(4000) + pick.choice([0, 0.999]), pick.randrange(4)) for _ in range(300)]
    events += [(1200, 1)] * 50 + [(0, 2), (slide, 2), (size, 2)]
    df = clicks(*((s, k, 0) for s, k in events))
    result = c.sliding_counts(df, "user_id", size, slide)
    assert rows(result, "user_id", "window_end_ms", "click_count") == expected_windows(events, size, slide)


def test_windows_without_gaps_only(clicks):
    with pytest.raises(ValueError):
        c.sliding_counts(clicks((0, 1, 1)), "user_id", 30, 60)
    with pytest.raises(ValueError):
        c.blacklist_candidates(clicks((0, 1, 1)), None, None, size=100, slide=40)


def test_window_excludes_its_end(clicks, rows):
    result = c.click_trend(clicks((1704067200, 1, 5)))
    ends = [end for (end,) in rows(result, "window_end")]
    assert (ends[0], ends[-1], len(ends)) == ("20240101000100", "20240101001000", 10)


def test_candidates_need_more_than_the_threshold(clicks, frame, rows):
    def burst(user, n, start=0, step=0):
        return [(start + step * i, user, 1) for i in range(n)]

    df = clicks(
        *burst(1, 100),
        *burst(2, 101),
        *burst(3, 150),  # whitelisted
        *burst(4, 150),  # listed already
        *burst(5, 60, start=0),
        *burst(5, 60, start=400),  # never in one window
        *burst(6, 101, start=0, step=2.9),  # spread over 290 s
        *burst(7, 101, start=10, step=2.9),  # from 10 s to 300 s: no window holds all
    )
    result = c.blacklist_candidates(df, frame(USERS, (4,)), frame(USERS, (3,)))
    assert rows(result, "user_id", "count") == [(2, 101), (6, 101)]


def test_candidates_are_the_fullest_windows(clicks, frame, rows):
    pick = random.Random(5)
    events = [(pick.randrange(3000), pick.randrange(5)) for _ in range(400)]
    best = Counter()
    for key, _, n in expected_windows(events, 300, 30):
        best[key] = max(best[key], n)
    none = frame(USERS)
    result = c.blacklist_candidates(clicks(*((s, k, 0) for s, k in events)), none, none, threshold=12)
    assert rows(result, "user_id", "count") == sorted((k, n) for k, n in best.items() if n > 12)


def test_counts_per_day_and_province(frame, rows):
    day = 86_400_000
    df = frame(
        CLICK,
        (0, "p", "c", 1, 1),
        (day - 1, "p", "d", 2, 1),
        (day, "p", "c", 1, 1),
        (0, "q", "c", 1, 1),
    )
    running = c.running_counts(df)
    assert rows(running, "date", "province", "city", "ad_id", "click_count") == [
        ("1970-01-01", "p", "c", 1, 1),
        ("1970-01-01", "p", "d", 1, 1),
        ("1970-01-01", "q", "c", 1, 1),
        ("1970-01-02", "p", "c", 1, 1),
    ]
    province = rows(c.province_counts(running))
    assert province == [("1970-01-01", "p", 1, 2), ("1970-01-01", "q", 1, 1), ("1970-01-02", "p", 1, 1)]
    assert rows(c.province_click_counts(df)) == province


def test_top_ads(frame, rows):
    counts = frame(
        "date string, province string, ad_id int, click_count bigint",
        *(("d", "p", ad, 3 if ad == 9 else 1) for ad in range(10, 0, -1)),
    )
    assert rows(c.top_province_ads(counts), "rn", "ad_id") == [(1, 9), (2, 1), (3, 2), (4, 3), (5, 4)]
