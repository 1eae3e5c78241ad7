"""Operator 12: phrases against a search word by word, notices with words left out, added and changed, the SQL."""

import random
import re

import duckdb

from churnlens.llm import licenses

PHRASES = {("mit", "license"): "mit", ("apache", "license"): "apache", ("general", "public", "license"): "gpl"}


def words(text):
    return [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+",
                                "".join(c.lower() if c.isascii() else c for c in text or "")) if w]


def phrases(text):
    w = words(text)
    return len(w), sorted((i, label) for p, label in PHRASES.items() for i in range(len(w)) if tuple(w[i:i + len(p)]) == p)


def frame(spark, rows, more=""):
    return spark.createDataFrame(rows, "doc_id long, text string" + more)


def check(found, docs):
    """Base spans of every row, repeated ones too."""
    seen = sorted((r.doc_id or -1, r.n_words, sorted((s.start, s.label) for s in r.spans if s.base)) for r in found)
    assert seen == sorted((d or -1, *phrases(t)) for d, t in docs)


def test_phrases(spark):
    r = random.Random(2)
    pieces = ["MIT", "license", "License.", "apache", "Apache-License", "general", "public", "GENERAL public", "été", "mit",
              "licenses", "submit", "É", "x license", "public\nlicense", "🙂", "_license_", "K", "K"]
    docs = [(i, " ".join(r.choice(pieces) for _ in range(r.randrange(60)))) for i in range(150)]
    docs += [(200, "mit license " * 3000), (201, None), (201, None), (202, ""), (203, "mit"), (204, "License MIT"),
             (205, "general public license"), (205, "apache license"), (205, "apache license"), (None, "MIT License")]
    found = licenses.scan(frame(spark, docs)).collect()
    check(found, docs)
    assert sum(len(r.spans) for r in found if r.doc_id == 200) == 3000


def test_notices(spark):
    notice = next(t.text for t in licenses.NOTICES if t.label == "bsd").split()
    filler = "quite other words before and after it".split()
    dropped = notice[:6] + notice[9:]
    added = notice[:8] + "of every kind known".split() + notice[8:]
    changed = [("other" if i == 10 else w) for i, w in enumerate(notice)]
    texts = {1: notice, 2: filler * 3 + notice + filler, 3: filler + dropped, 4: added + filler, 5: changed,
             6: notice[:7] + filler, 7: notice + filler * 9 + notice, 8: sorted(notice), 9: filler}
    found = {r.doc_id: [s for s in r.spans if s.label == "bsd"] for r in licenses.scan(
        frame(spark, [(k, " ".join(v)) for k, v in texts.items()])).collect()}
    assert [(s.start, s.length, s.share) for s in found[1]] == [(0, len(notice), 1.0)]
    assert [(s.start, s.length) for s in found[2]] == [(21, len(notice))]
    for k, start, length in ((3, 7, len(dropped)), (4, 0, len(added)), (5, 0, len(notice))):
        (span,) = found[k]  # two diagonals, one span
        assert (span.start, span.length) == (start, length) and 0.6 <= span.share < 1
    assert [s.start for s in found[7]] == [0, len(notice) + 63]
    assert not found[6] and not found[8] and not found[9]


def test_other_templates(spark):
    own = (licenses.Template("house", "all rights reserved by the house of words"), licenses.Template("c", "copyright word", True))
    (row,) = licenses.scan(frame(spark, [(1, "Copyright: word. All rights reserved by the house, of words")]), own).collect()
    assert [(s.start, s.length, s.label, s.base) for s in row.spans] == [(0, 2, "c", True), (2, 8, "house", False)]


def test_odd_rows(spark, odd, none):
    docs = [(r.doc_id, r.text) for r in odd.collect()]
    check(licenses.scan(odd).collect(), docs)
    assert licenses.scan(none).count() == 0


def test_sql(spark, tmp_path):
    notice = {t.label: t.text for t in licenses.NOTICES}
    docs = [(d, t) for d, t in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    docs += [(1000, notice["mit"][20:]), (1001, "x " + notice["gpl"].replace("terms", "words")), (1002, None),
             (1002, ""), (1002, ""), (None, "MIT license, apache license"), (1003, notice["apache"] + " " + notice["bsd"])]
    frame(spark, docs).write.parquet(f"{tmp_path}/documents.parquet")
    found = licenses.op12_license_scan(spark, str(tmp_path))
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    expected = con.sql(licenses.ORACLE)
    assert expected.columns == found.columns
    rows = sorted(map(tuple, found.collect()), key=str)
    assert rows == sorted(expected.fetchall(), key=str)
    assert {r[6] for r in rows} >= {"", "mit", "gpl", "apache,bsd", "apache,mit"}
