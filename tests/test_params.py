import pytest

from clickpulse.params import JobParams, task_params
from clickpulse.sources.jdbc import find_params


def test_all_parameters():
    params = JobParams.from_json(
        '{"startDate":"2024-01-01","endDate":" 2024-01-31","sex":"male","professionals":"a, b,,"}'
    )
    assert params == JobParams("2024-01-01", " 2024-01-31", "male", ("a", " b"))
    assert params.needs_users


@pytest.mark.parametrize("value", ['""', '"  "', "null", '",, "'])
def test_blank_parameters_are_absent(value):
    params = JobParams.from_json(f'{{"sex":"","professionals":{value}}}')
    assert params == JobParams()
    assert not params.needs_users


def test_numbers_become_text():
    assert JobParams.from_json('{"sex":1}').sex == "1"


@pytest.mark.parametrize("text", [None, "", "{}", "[]", "null"])
def test_no_parameters(text):
    with pytest.raises(ValueError):
        JobParams.from_json(text)


def test_find_params(frame):
    tasks = frame("task_id bigint, task_param string", (1, '{"sex":"male"}'), (2, "{}"))
    assert find_params(tasks, 1).sex == "male"
    for unknown in (2, 3):
        with pytest.raises(ValueError):
            find_params(tasks, unknown)


TEXTS = [
    None,
    "",
    " \t",
    "{}",
    " { } ",
    "[]",
    "[1]",
    "null",
    "7",
    "{",
    "no object",
    '{"startDate":"2024-01-01","endDate":" 2024-01-31","sex":"male","professionals":"a, b,,"}',
    ' \n{"sex":" ","professionals":",, ","other":{"a":[1]}}',
    '{"sex":1,"startDate":null,"endDate":true,"professionals":"x"}',
]


def test_parameters_of_many_tasks(frame):
    """The columns say what JobParams says about each task alone."""
    tasks = frame("task_id bigint, task_param string", *enumerate(TEXTS))
    got = {row.task_id: tuple(row)[1:] for row in task_params(tasks).collect()}
    for n, text in enumerate(TEXTS):
        try:
            params = JobParams.from_json(text)
            want = (False, params.start_date, params.end_date, params.sex, list(params.professionals))
        except ValueError:
            want = (True, None, None, None, [])
        assert got[n] == want, text
