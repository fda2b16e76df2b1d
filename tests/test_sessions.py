import json

import pytest

from clickpulse.operators import sessions

LENGTHS = [0, 4, 5, 10, 11, 30, 31, 59, 60, 179, 180, 359, 360]


@pytest.fixture
def actions(frame):
    def make(*rows):
        return frame("session_id string, action_time string", *rows)

    return make


def test_lengths(actions, rows):
    df = actions(
        ("a", "2024-01-01 08:59:00"),
        ("a", "2024-01-01 09:02:00"),
        ("a", "2024-01-01 09:00:30"),
        ("b", "2024-01-01 23:59:59"),
        ("c", "2024-01-31 23:59:59"),
        ("c", "2024-02-01 00:00:00"),
    )
    lengths = sessions.session_lengths(df)
    assert rows(lengths) == [("a", 180), ("b", 0), ("c", 1)]
    assert rows(sessions.session_totals(lengths)) == [(3, 181, 1)]


def test_totals_of_nothing(actions, rows):
    assert rows(sessions.session_totals(sessions.session_lengths(actions()))) == [(0, 0, 0)]


def test_histogram_bounds(frame, rows):
    df = frame("session_id string, length_s bigint", *((str(n), n) for n in LENGTHS))
    assert rows(sessions.length_histogram(df)) == [
        ("A", 2),
        ("B", 2),
        ("C", 2),
        ("D", 2),
        ("E", 2),
        ("F", 2),
        ("G", 1),
    ]


def test_session_across_an_hour(actions, rows):
    df = actions(("a", "2024-01-01 08:59:00"), ("a", "2024-01-01 09:02:00"), ("b", "2024-01-01 09:00:00"),
                 ("b", "2024-01-01 09:00:07"))
    hours = sessions.hourly_session_lengths(df)
    assert rows(hours, "day", "hour", "session_id", "length_ms") == [
        ("2024-01-01", 8, "a", 0),
        ("2024-01-01", 9, "a", 0),
        ("2024-01-01", 9, "b", 7000),
    ]
    assert rows(sessions.hourly_session_counts(hours)) == [("2024-01-01", 8, 1), ("2024-01-01", 9, 2)]
    assert rows(sessions.hourly_length_totals(hours)) == [("2024-01-01", 8, 0), ("2024-01-01", 9, 7000)]
    assert rows(sessions.hourly_invalid_sessions(hours)) == [("2024-01-01", 8, 1), ("2024-01-01", 9, 1)]


def test_valid_hours_are_absent(actions, rows):
    hours = sessions.hourly_session_lengths(
        actions(("a", "2024-01-01 09:00:00"), ("a", "2024-01-01 09:00:01"))
    )
    assert rows(sessions.hourly_invalid_sessions(hours)) == []


def test_report(actions):
    df = actions(("a", "2024-01-01 08:59:00"), ("a", "2024-01-01 09:02:00"), ("b", "2024-01-01 09:00:00"))
    assert json.loads(sessions.session_report(df).first().report) == {
        "total_session_count": 2,
        "total_session_length": "180",
        "invalid_session_count": 1,
        "pre_session_type_of_count": [{"type": "A", "count": 1}, {"type": "F", "count": 1}],
        "pre_hour_of_session_count": [
            {"day": "2024-01-01", "hour": 8, "count": 1},
            {"day": "2024-01-01", "hour": 9, "count": 2},
        ],
        "pre_hour_of_session_length": [
            {"day": "2024-01-01", "hour": 8, "length": 0},
            {"day": "2024-01-01", "hour": 9, "length": 0},
        ],
        "pre_hour_of_invalid_session_count": [
            {"day": "2024-01-01", "hour": 8, "invalid": 1},
            {"day": "2024-01-01", "hour": 9, "invalid": 2},
        ],
    }


def test_report_of_nothing(actions):
    report = json.loads(sessions.session_report(actions()).first().report)
    assert report["total_session_count"] == 0
    assert report["total_session_length"] == "0"
    assert report["pre_hour_of_session_count"] == []
