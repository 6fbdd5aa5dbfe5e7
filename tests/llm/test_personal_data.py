import re

import pytest

from clickfeat.llm import personal_data as pd_

#: The base rules as they are stated.
RULES = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    turned = [int(d) for d in reversed(digits)]
    return (sum(turned[::2]) + sum(sum(divmod(2 * d, 10)) for d in turned[1::2])) % 10 == 0


def good(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        return 16 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 8 <= len(digits) <= 15


def brute(text):
    return [
        (n, m.start(), m.end())
        for n, (kind, rule) in enumerate(RULES.items())
        for m in re.finditer(rule, text or "")
        if good(kind, m.group())
    ]


TEXTS = [
    None, "", "nothing", "a@b.c", "a@b.c@d.e", "x@y.z.@q.r", "a@b.c_d@e.f", "@a.b a@ a@b a@.c é@b.c", "a@b.c.d..e@f.g",
    "1.2.3.4", "1.2.3.4.5.6.7.8", "256.1.1.1 1.2.3.256 001.002.003.004", "1.2.3.4567", "x1.2.3.4y",
    "4532 0151 1283 0366", "4532015112830366 4532-0151-1283-0367", "4532015112830366 4532015112830366", "1-2 3",
    "+1 (947) 555-7668 and +12 and +1234567 x +1.2.3.4.5.6.7.8 +()", "++1 555 123 4567", "🙂 +49 30 1234567 🙂 a@b.de 漢 10.0.0.1",
    "9" * 40_000, "a" * 40_000 + "@b.c", "x@" + "b." * 20_000 + "c", "+1" + " " * 40_000 + "2", "1." * 20_000, "1 " * 20_000,
    "a.b-c_d%e+f@g-h.i mail a@b.c, +1 234 567 8901.",
]


def test_base_spans_against_the_rules(documents):
    got = {r["doc_id"]: r for r in pd_.find_personal_data(documents(list(enumerate(TEXTS)))).collect()}
    for i, text in enumerate(TEXTS):
        assert sorted(tuple(s) for s in got[i]["base"]) == sorted(brute(text)), (text or "")[:80]


#: Valid spans without three or four digits in a row.
SPARSE = ["+33 1 23 45 67 89", "453 201 511 283 036 6", "4 5 3 2 0 1 5 1 1 2 8 3 0 3 6 6", "+3-3.1 (2)3 4", "45 32-01 51-12 83 03 66 x"]


def test_base_spans_in_short_runs_of_digits(documents):
    got = {r["doc_id"]: r for r in pd_.find_personal_data(documents(list(enumerate(SPARSE)))).collect()}
    for i, text in enumerate(SPARSE):
        assert sorted(tuple(s) for s in got[i]["base"]) == sorted(brute(text)), text
    assert all(brute(SPARSE[i]) for i in (0, 1, 2, 4))


def test_given_documents(small):
    docs = small("documents")
    got = {r["doc_id"]: r for r in pd_.find_personal_data(docs).collect()}
    for r in docs.collect():
        assert sorted(tuple(s) for s in got[r["doc_id"]]["base"]) == sorted(brute(r["text"]))


@pytest.fixture(scope="module")
def labelled(spark):
    """Many good and bad addresses and cards, and spellings that no base rule covers."""
    rows = []
    for i in range(400):
        card = f"{4000_0000_0000_000 + i * 7919:015}"
        check = next(d for d in "0123456789" if luhn(card + d))
        wrong = str((int(check) + 3) % 10)
        rows.append((i, f"the server {i % 250}.1.2.3 and {300 + i}.1.2.3 card {card}{check} or {card}{wrong} here"))
    rows += [(1000 + i, f"card {'/'.join(['4532', '0151', '1283', '0366'])} or 4532/0151/1283/0367 ok") for i in range(5)]
    return spark.createDataFrame(rows, "doc_id bigint, text string")


def test_trees_add_valid_cards_in_other_spellings_only(labelled):
    for r in pd_.find_personal_data(labelled).collect():
        if r["doc_id"] < 1000:
            assert not r["added"]
        else:
            assert [tuple(s) for s in r["added"]] == [(2, 5, 24)]


def test_no_python_runs(labelled):
    plan = pd_.find_personal_data(labelled)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_rows_and_columns(documents):
    docs = documents([(1, "a@b.c"), (1, "a@b.c"), (None, "1.2.3.4")])
    got = pd_.find_personal_data(docs).collect()
    assert sorted((r["doc_id"] is None, len(r["base"])) for r in got) == [(False, 1), (False, 1), (True, 1)]
    assert pd_.find_personal_data(documents([])).collect() == []
    texts = [r["text"] for r in pd_.redact(documents([(1, "é a@b.c 🙂 1.2.3.4 z"), (2, None)])).orderBy("doc_id").collect()]
    assert texts == ["é [redacted] 🙂 [redacted] z", None]
