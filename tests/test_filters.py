import pytest

from clickpulse.operators.filters import filter_actions
from clickpulse.params import JobParams


@pytest.fixture
def actions(frame):
    return frame(
        "date string, user_id bigint, page_id bigint",
        ("2024-01-01", 1, 10),
        ("2024-01-02", 1, 11),
        ("2024-01-03", 2, 12),
        ("2024-01-03", 9, 13),
    )


@pytest.fixture
def users(frame):
    return frame(
        "user_id bigint, sex string, professional string",
        (1, "male", "doctor"),
        (2, "female", " nurse"),
        (2, "female", " nurse"),
    )


@pytest.mark.parametrize(
    "params, pages",
    [
        (JobParams(), [10, 11, 12, 13]),
        (JobParams(start_date="2024-01-02"), [11, 12, 13]),
        (JobParams(end_date="2024-01-02"), [10, 11]),
        (JobParams(start_date="2024-01-02", end_date="2024-01-02"), [11]),
        (JobParams(sex="male"), [10, 11]),
        (JobParams(sex="female"), [12]),
        (JobParams(professionals=("doctor", "nurse")), [10, 11]),
        (JobParams(professionals=(" nurse",)), [12]),
        (JobParams(sex="male", professionals=(" nurse",)), []),
        (JobParams(start_date="2024-01-02", sex="male"), [11]),
    ],
)
def test_filters(actions, users, rows, params, pages):
    result = filter_actions(actions, users, params)
    assert result.columns == actions.columns
    assert rows(result, "page_id") == [(page,) for page in pages]
