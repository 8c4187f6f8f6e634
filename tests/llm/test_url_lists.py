from datetime import date

import pytest

from daybook.llm import url_lists

CAPTURES = "page_id long, url string, fetched_at date, rule string, month int, lists string"
ENTRIES = "list string, rule string, action string, at date"
D = [date(2024, m, 1) for m in range(1, 13)]


def judged(spark, captures, entries):
    frame = spark.createDataFrame([(*c, "r", 1, "l") for c in captures], CAPTURES)
    found = url_lists.judge_captures(frame, spark.createDataFrame(entries, ENTRIES)).collect()
    return sorted(((r.page_id, r.host, r.n_active, r.lists, r.listed) for r in found), key=str)


def test_as_of_fetch_time(spark):
    entries = [
        ("a", "Bad.com", "add", D[1]),
        ("a", "bad.com", "remove", D[3]),
        ("a", "bad.com", "add", D[5]),
        ("a", "bad.com", "add", D[6]),
        ("b", "www.bad.com", "add", D[5]),
        ("b", "odd.org", "add", D[2]),
        ("b", "odd.org", "remove", D[2]),
        ("b", "com", "add", D[0]),
        ("b", None, "add", D[0]),
        ("b", "bad.com", "perhaps", D[0]),
    ]
    captures = [
        (1, "http://WWW.bad.com/x", D[0]),
        (2, "http://www.bad.com:80/x", D[1]),
        (3, "https://u@bad.com", D[3]),
        (4, "https://www.bad.com/?q", D[6]),
        (5, "http://odd.org/", D[4]),
        (6, "no url", D[4]),
        (7, None, D[4]),
        (8, "http://bad.com/", None),
        (9, "http://com/", D[4]),
        (9, "http://com/", D[4]),
    ]
    none = (0, "", False)
    assert judged(spark, captures, entries) == sorted(
        [
            (1, "www.bad.com", *none),
            (2, "www.bad.com", 1, "a", True),
            (3, "bad.com", *none),
            (4, "www.bad.com", 2, "a,b", True),
            (5, "odd.org", *none),
            (6, None, *none),
            (7, None, *none),
            (8, "bad.com", *none),
            (9, "com", 1, "b", True),
            (9, "com", 1, "b", True),
        ],
        key=str,
    )


@pytest.mark.parametrize("entries", [[], [("a", "b.c", "remove", D[0])]])
def test_nothing_listed(spark, entries):
    assert judged(spark, [(1, "http://b.c/", D[1])], entries) == [(1, "b.c", 0, "", False)]
    assert judged(spark, [], entries) == []
