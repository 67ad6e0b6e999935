"""Secret and license scans against plain Python and SQL."""

import hashlib
import random
import re
from collections import Counter

import duckdb
import pyarrow as pa
import pytest

from txnguard.llm import oracle_sql
from txnguard.llm.license_scan import GATE, LICENSES, WORD, detect, license_scan, rules
from txnguard.llm.secret_scan import redact_secrets, secret_scan

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
BASE = (("assign", ASSIGN, lambda m: len(m[2]) >= 6), ("access", re.compile("AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20), ("hex", re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 24))


def base_spans(text):
    found = [(m.start(), k, f"{kind}:{m.start()}:{m.end()}") for k, (kind, p, ok) in enumerate(BASE) for m in p.finditer(text) if ok(m)]
    return [s for *_, s in sorted(found)]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    parts = ["password", "PassWD", "secret", "token", "api_key", "APIKEY", '"', "'", " ", ":", "=", "abcdefgh", "é", "😀", "AKIA", "ABCDEFGH1234567890"]
    parts += ["0123456789abcdef0123456789", "\n", "AKIAAKIA", "ghp_" + "a1B2" * 9, "/+.-_", "eyJhbGciOiJ9.eyJhbGciOiJ9.abc", "-----BEGIN RSA PRIVATE KEY-----"]
    out = [(i, "".join(rng.choice(parts) for _ in range(rng.randint(0, 25))) if i % 17 else None) for i in range(400)]
    return out + out[:3] + [(None, 'token = "0123456789abcdef0123456789"'), (None, None), (900, "token=abcdef " * 500)]


def test_secret_base_spans(rows, make_docs):
    got = secret_scan(make_docs(rows, clash=True)).collect()
    expected = Counter()
    for i, t in rows:
        spans = base_spans(t or "")
        n = Counter(s.split(":")[0] for s in spans)
        expected[i, n["assign"], n["access"], n["hex"], hashlib.sha256(",".join(spans).encode()).hexdigest()] += 1
    assert Counter(tuple(r)[:5] for r in got) == expected
    by_hash = {hashlib.sha256(",".join(base_spans(t or "")).encode()).hexdigest(): base_spans(t or "") for _, t in rows}
    for r in got:  # base ones stay
        assert set(by_hash[r.base_sha256]) <= set(r.spans.split(",")) | {""}
    assert secret_scan(make_docs([])).count() == 0


def test_secret_scan_is_its_sql(rows, make_docs):
    df = make_docs(rows)
    documents = df.toArrow()
    assert isinstance(documents, pa.Table)
    con = duckdb.connect()
    expected = con.execute(oracle_sql.secret_scan(max_owners=1)).fetchall()
    names = [d[0] for d in con.description]
    got = [tuple(r[n] for n in names) for r in secret_scan(df, max_owners=1).collect()]
    assert Counter(got) == Counter(expected)


def test_copied_examples_and_live_credentials(spark):
    example, live, added = "0123456789abcdef01234567" + "89", "9f8e7d6c5b4a39281706f5e4d3c2", "ghp_" + "q9W8" * 9
    rows = [(i, f"token={example}", f"s{i}") for i in range(5)] + [(10, f"token={live} {added}", "s1"), (11, f"token={live}", "s1")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.doc_id: r for r in secret_scan(df).collect()}
    assert got[0].n_copied == 2 and got[0].n_live == 0
    assert got[10].n_copied == 0 and "github:" in got[10].spans
    texts = {r.doc_id: r.text for r in redact_secrets(df).collect()}
    assert texts[0] == f"token={example}" and texts[10] == "token=[secret] [secret]" and texts[11] == "token=[secret]"


def test_redaction_keeps_columns_and_other_rows(awkward, make_docs):
    df = make_docs(awkward, clash=True)
    out = redact_secrets(df)
    assert out.dtypes == df.dtypes
    clean = Counter((i, t) for i, t in awkward if not base_spans(t or ""))
    assert clean <= Counter((r.doc_id, r.text) for r in out.select("doc_id", "text").collect())


def base_license(text):
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text))
    found = [
        (k, label)
        for phrase, label in (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
        for k in range(len(words))
        if words[k : k + len(phrase.split())] == phrase.split()
    ]
    at = [k for k, _ in found]
    return len(words), len(found), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in found}))


def test_license_base(awkward, make_docs):
    rng = random.Random(3)
    parts = ["MIT", "License", "license", "Apache", "general", "public", " ", "\n", ", ", "-", "ſ", "é", "\x00", "GNU", "version 2.0", "permit"]
    rows = awkward + [(2000 + i, "".join(rng.choice(parts) + rng.choice([" ", ""]) for _ in range(rng.randint(0, 40)))) for i in range(300)]
    rows.append((5000, "mit license " * 5000))
    got = license_scan(make_docs(rows, clash=True), with_hits=True).collect()
    assert Counter(tuple(r)[:6] for r in got) == Counter((i, *base_license(t or "")) for i, t in rows)
    for r in got:
        assert {*r.base_labels.split(",")} - {""} <= set(r.labels.split(",")) and 0 <= r.score <= 1
    assert license_scan(make_docs([])).count() == 0


def hits(text):
    words = WORD.findall(text.lower())
    at, places = 1, []
    for w in words:
        places.append(at)
        at += len(w) + 1
    return [(h.start, h.end, h.label) for h in detect(" " + " ".join(words) + " ", places, rules())]


def test_license_rules():
    assert len(rules()) > 200
    assert hits("Licensed under the Apache License, Version 2.0.") == [(0, 8, "apache-2.0")]
    assert hits("SPDX-License-Identifier: GPL-2.0-or-later") == [(0, 8, "gpl-2.0")]
    assert hits("This is licensed under the GNU General Public License, version 3") == [(2, 11, "gpl-3.0")]
    assert [h[2] for h in hits("mit license and then the bsd license")] == ["mit", "bsd"]
    assert hits("permit license") == [] and hits("") == []


def samples(parsed):
    """Texts of a parsed pattern: each branch and each optional part, one at a time."""
    out = [""]
    for op, arg in parsed:
        name = str(op)
        if name == "LITERAL":
            some = [chr(arg)]
        elif name == "IN":
            some = [chr(x) for _, x in arg]
        elif name == "SUBPATTERN":
            some = samples(arg[-1])
        elif name == "BRANCH":
            some = [x for branch in arg[1] for x in samples(branch)]
        elif name == "MAX_REPEAT":
            some = ["", samples(arg[2])[0]]
        else:
            assert name == "ASSERT"
            continue
        out = [out[0] + x for x in some] + [x + some[0] for x in out[1:]]
    return out


def test_every_rule_passes_its_gates():
    for rule in rules():
        found = samples(re._parser.parse(rule.pattern.pattern))
        for text in found:
            assert rule.pattern.fullmatch(f" {text} ", 1, len(text) + 2) or rule.pattern.search(f" {text} ")
            assert rule.keyword in f" {text} ", (rule, text)
            assert any(g in text.encode() for g in GATE), (rule, text)


def test_licenses_stated_by_identifier_alone(make_docs):
    rows = [(k, f"SPDX-License-Identifier: {spdx.replace(' ', '-').upper()}") for k, (_, spdx, *_) in enumerate(LICENSES)]
    rows += [(1000 + k, f"license: {spdx}") for k, (_, spdx, *_) in enumerate(LICENSES)] + [(5000, "MIT No Attribution")]
    got = {r.doc_id: r.labels.split(",") for r in license_scan(make_docs(rows)).collect()}
    for k, (label, *_) in enumerate(LICENSES):
        assert label in got[k] and label in got[1000 + k], label
    assert got[5000] == ["mit-0"]


def test_one_owners_value_in_many_documents_is_redacted(spark):
    live = "9f8e7d6c5b4a39281706f5e4d3c2"
    df = spark.createDataFrame([(i, f"token={live}", "s1") for i in range(30)], "doc_id long, text string, source string")
    assert {r.text for r in redact_secrets(df).collect()} == {"token=[secret]"}


@pytest.mark.parametrize("n", [21, 1000])
def test_one_owner_is_never_a_copied_example(spark, n):
    live, github = "9f8e7d6c5b4a39281706f5e4d3c2", "ghp_" + "q9W8" * 9
    df = spark.createDataFrame([(i, f"token={live} {github}", "s1") for i in range(n)], "doc_id long, text string, source string")
    for r in secret_scan(df).collect():
        assert r.n_copied == 0 and r.n_live >= 2 and "github:" in r.spans
    assert {r.text for r in redact_secrets(df).collect()} == {"token=[secret] [secret]"}


def test_very_many_matches_in_one_text(spark):
    import time

    one, n = "token=abcd3f9é ", 200_000
    df = spark.createDataFrame([(1, one * n, "s")], "doc_id long, text string, source string")
    t = time.perf_counter()
    r = secret_scan(df).first()
    assert r.n_assign == n and r.spans.endswith(f"assign:{(n - 1) * len(one)}:{n * len(one) - 2}")
    text = redact_secrets(df).first().text
    assert text == "token=[secret]é " * n
    assert time.perf_counter() - t < 60
