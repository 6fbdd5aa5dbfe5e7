import re

import pytest

from clickfeat.llm import quality_rules as q

GOOD = " ".join(f"word{i}" for i in range(30)) + "."
LONG = "\n".join([GOOD, GOOD.replace("word", "term"), GOOD.replace("word", "name")])


def brute_repeats(words):
    seen = {}
    for i in range(len(words) - 2):
        seen.setdefault(tuple(words[i : i + 3]), []).append(i)
    return len({i + k for at in seen.values() if len(at) > 1 for i in at for k in range(3)})


@pytest.mark.parametrize(
    "text", ["", "a", "a b", "a b c", "a b a b a b", "a b c d a b c", "x x x x", LONG, "é  ñ\té ñ é ñ   b"]
)
def test_repeated_words(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    assert q.repeated_words(text.encode().split()) == brute_repeats(words)


def test_lines():
    assert not q.line_fails("A plain sentence with some words.", 6)
    assert q.line_fails("no end mark here", 4)
    assert q.line_fails("Home | News | About | Contact.", 7)
    assert q.line_fails("a### b*** c.", 3)
    assert q.line_fails("EVERY WORD IS LOUD HERE.", 5)
    assert q.line_fails("Please accept cookies to go on.", 6)


def rows(documents, texts):
    docs = documents(list(enumerate(texts)))
    return {r["doc_id"]: r for r in q.line_first(docs).collect()}


def test_documents(documents):
    menu = "Home | News | About | Contact | Help\n" * 30
    texts = [LONG, menu, LONG + "\n" + "a | b | c", "short text.", None, "", "same same same " * 60, LONG + " x" * 200_000 + "."]
    got = rows(documents, texts)
    assert [got[i]["quality"]["kept"] for i in range(7)] == [True, False, True, False, False, False, False]
    assert got[2]["quality"]["clean_text"] == LONG
    assert got[4]["quality"]["n_words"] == 0 and got[4]["quality"]["clean_text"] == ""
    assert got[6]["quality"]["base_failed"] and not got[0]["quality"]["base_failed"]
    assert got[7]["quality"]["n_words"] == 90 + 200_000


def test_counts(documents):
    got = rows(documents, ["a b\nc & d\na b\n \na b\né\t#"])[0]["quality"]
    assert (got["n_words"], got["word_chars"], got["n_symbols"], got["n_dup_lines"]) == (11, 11, 2, 2)


def test_cleaned_documents_keep_their_columns(documents):
    docs = documents([(1, LONG + "\na | b | c"), (1, LONG + "\na | b | c"), (2, "junk")])
    cleaned = q.clean(docs).collect()
    assert q.clean(docs).columns == docs.columns
    assert [(r["doc_id"], r["text"], r["n_chars"], r["_quality"]) for r in cleaned] == [(1, LONG, len(LONG), 0)] * 2
    assert q.clean(documents([])).collect() == []
