import re
from collections import Counter, defaultdict

import duckdb
import pytest
from lattica.llm import quality_rules as rules
from lattica.llm.common import table
from lattica.llm.queries import op9_quality_rules
from tests.llm.helpers import AWKWARD, docs

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    at = defaultdict(list)
    for i in range(len(words) - 7):
        at[tuple(words[i : i + 8])].append(i)
    marked = {j for p in at.values() if len(p) > 1 for i in p for j in range(i, i + 8)}
    n = len(words)
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(marked), n < 20 or 100 * len(marked) > 30 * n


def got(df):
    return Counter((r.own.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in df.collect())


def test_base_of_awkward_documents(spark):
    rows = [*AWKWARD, (20, "a b c d e f g h " * 3), (21, "x\nx\n \ny\nx"), (22, "a a a a a a a a a"), (23, "#*$%&|<>   é\U0001f600")]
    df = docs(spark, rows, words=1, lines="l", left=2, kept="no", cleaned=0)
    assert got(rules.judged(df)) == Counter((i, *base(t)) for i, t in rows)


def test_base_of_real_documents(spark):
    df = table(spark, "/root/testdata/sf0.01", "documents")
    assert got(rules.judged(df)) == Counter((r.doc_id, *base(r.text)) for r in df.collect())


GOOD = "Here is a plain sentence, with enough words in it to be kept by all the rules there are."


@pytest.mark.parametrize("line,fails", [
    ("Home | News | Sports | About", True), ("a | b", False), ("One: pipe | in a long sentence is nothing that a menu would have, surely.", False),
    ("ALL!! THE!! WORDS!!", True), ("Wow!! That is a surprise.", False), ("of%%% the&&& day### was$$$", True), ("It costs $5 & 10% more.", False),
    ("Licensed under CC BY 4.0.", True), ("We accept that cookies taste good.", False), ("word " * 30, True), ("word " * 10, False), ("", False), ("\t ", False),
])
def test_lines(spark, line, fails):
    (row,) = rules.judged(docs(spark, [(1, f"{GOOD}\n{line}\n{GOOD}")])).collect()
    assert row.cleaned == (f"{GOOD}\n{GOOD}" if fails else f"{GOOD}\n{line}\n{GOOD}")


def test_verdict_follows_the_loss(spark):
    menu = "Home | News | Sports | About | Contact | Imprint | Help"
    more = "Another sentence follows, so that this document has more than twenty words."
    rows = [(1, f"{GOOD}\n{more}\n{menu}"), (2, f"{GOOD}\n" + "\n".join(f"{menu} | {i}" for i in range(9))), (3, "Too short.")]
    left = rules.filtered(docs(spark, rows, low="x"))
    assert left.columns[-1] == "low"
    assert [(r.doc_id, r.text, r.n_chars) for r in left.collect()] == [(1, f"{GOOD}\n{more}", len(GOOD) + len(more) + 1)]


def test_good_documents_stay_and_junk_goes(spark):
    sf = "/root/testdata/sf0.01"
    kept = {r.doc_id: r.kept for r in op9_quality_rules(spark, sf).collect()}
    labels = duckdb.sql(f"select doc_id, quality from '{sf}/labels.parquet'").fetchall()
    good = [kept[i] for i, q in labels if q == 1]
    junk = [kept[i] for i, q in labels if q == 0]
    assert sum(good) >= 0.9 * len(good), (sum(good), len(good))
    assert sum(junk) <= 0.35 * len(junk), (sum(junk), len(junk))


def test_empty_table(spark):
    assert rules.judged(docs(spark, [])).collect() == [] == rules.filtered(docs(spark, [])).collect()


@pytest.mark.parametrize("line", ["© 2020 Muster GmbH. Alle Rechte vorbehalten.", "Politique de confidentialité et mentions légales.", "Todos los derechos reservados, 2021.", "All rights reserved, 2019."])
def test_boilerplate_lines_of_four_languages_go(spark, line):
    text = "A first sentence that stays as it is, with words enough to count.\n" + line + "\nAnd a second one that stays too, being as plain as the first."
    (r,) = rules.filtered(docs(spark, [(1, text)])).collect()
    assert line not in r.text and r.text.count("stays") == 2
