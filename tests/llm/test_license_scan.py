import itertools
import re
from re import _parser as parser

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quayside.llm import license_scan
from quayside.llm.license_rules import BASE_PHRASES, LICENSES, PRIORITY, build_rules
from quayside.llm.license_scan import Place, Scanner, confidence, resolve, scan_column, scan_licenses

RULES = build_rules()


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def base_places(text):
    w = words(text)
    return sorted((i, label) for phrase, label in BASE_PHRASES.items() for i in range(len(w)) if w[i : i + len(phrase.split())] == phrase.split())


def plain(text):
    """All rules on every text, without keywords, and suppression by comparing all pairs."""
    clean = " ".join(words(text)).encode()
    places = [
        Place(rule, clean.count(b" ", 0, m.start()), clean.count(b" ", 0, m.end())) for rule in RULES for m in rule.pattern.finditer(clean)
    ]
    rank = lambda p: (PRIORITY[p.rule.kind], p.first - p.last, p.rule.order)
    kept = []
    for p in sorted(places, key=rank):
        p.kept = p.rule.kind == "base" or not any(q.first <= p.first and p.last <= q.last for q in kept)
        if p.kept:
            kept.append(p)
    return {(p.rule.order, p.first, p.last, p.kept) for p in places}


def samples(tree):
    """Strings of a pattern: every branch, repeats at their fewest and once."""
    out = [""]
    for op, value in tree:
        name = str(op)
        if name == "LITERAL":
            some = [chr(value)]
        elif name == "IN":
            some = [chr(v) if str(k) == "LITERAL" else chr(v[0]) if str(k) == "RANGE" else "7" if "DIGIT" in str(v) else "zz" for k, v in value]
        elif name == "SUBPATTERN":
            some = samples(value[3])
        elif name == "BRANCH":
            some = [x for branch in value[1] for x in samples(branch)]
        elif name == "MAX_REPEAT":
            some = [x * n for n in sorted({value[0], max(value[0], 1)}) for x in samples(value[2])]
        else:
            some = [""]
        out = [a + b for a in out for b in some][:4000]
    return out


TEXTS = [
    None, "", "   ", "CC BY", "cc-by cc\tby CC\nBY", "acc by", "ccby", "GNU General Public License, version 3 or later",
    "All Rights Reserved. Copyright (c) 2020 Acme Ltd. All rights reserved.", "MIT License\n\nPermission is hereby granted, free of charge, "
    "to any person obtaining a copy of this software and associated documentation files (the \"Software\")",
    "SPDX-License-Identifier: GPL-2.0-or-later", "licensed under CC BY-NC-SA 4.0, see https://creativecommons.org/licenses/by-nc-sa/4.0/",
    "Apache License, Version 2.0 and Apache-2.0 and apache2", "agpl3 lgplv2.1 mpl2 eupl1.2", "General Public License general public license",
    "日本語 all rights reserved 🙂", "general public\x00license", "no public domain of ours", "all rights reserved " * 300, "x" * 70_000,
    "the gnu general public license general public license version 2", "word " * 9_000 + "unlicense.org", "ALL RIGHTS. RESERVED",
]


def test_many_rules_with_their_gates():
    assert len(RULES) > 300 and len(LICENSES) > 60
    assert [r.order for r in RULES] == list(range(len(RULES)))
    assert [PRIORITY[r.kind] for r in RULES] == sorted(PRIORITY[r.kind] for r in RULES)


def test_no_gate_hides_a_rule():
    for rule in RULES:
        for sample in samples(parser.parse(rule.pattern.pattern.decode())):
            assert rule.pattern.fullmatch(sample.encode())
            found = set(words(sample))
            assert any(found.issuperset(gate) for gate in rule.gates), (rule, sample)


@pytest.mark.parametrize("slice_bytes", [None, 512])
def test_equals_all_rules_on_all_texts(monkeypatch, slice_bytes):
    if slice_bytes:
        monkeypatch.setattr(license_scan, "SLICE_BYTES", slice_bytes)
    scanner = Scanner(RULES)
    got = list(scan_column(scanner, pa.array(TEXTS)))
    assert len(got) == len(TEXTS)
    for text, (n, places) in zip(TEXTS, got):
        assert n == len(words(text))
        assert {(p.rule.order, p.first, p.last, p.kept) for p in places} == plain(text), text
        assert sorted((p.first, p.rule.label) for p in places if p.rule.kind == "base") == base_places(text)
        assert 0 <= confidence(places) <= 1 and (confidence(places) > 0) == any(p.kept for p in places)


def test_every_rule_is_found_in_a_text():
    scanner = Scanner(RULES)
    texts = [f"see {samples(parser.parse(r.pattern.pattern.decode()))[0]} here" for r in RULES]
    for rule, (_, places) in zip(RULES, scan_column(scanner, pa.array(texts))):
        assert rule.order in {p.rule.order for p in places}


def test_suppression_by_kind_length_and_order():
    by_kind = {k: [r for r in RULES if r.kind == k] for k in PRIORITY}
    title, notice, base = by_kind["title"][0], by_kind["notice"][0], by_kind["base"][0]
    places = resolve([Place(title, 3, 5), Place(notice, 2, 6), Place(title, 5, 8), Place(base, 3, 4), Place(by_kind["title"][1], 5, 8), Place(title, 6, 7)])
    assert {(p.rule.order, p.first) for p in places if p.kept} == {(notice.order, 2), (title.order, 5), (base.order, 3)}
    for a, b in itertools.permutations([Place(title, 0, 4), Place(by_kind["title"][1], 0, 4)]):
        assert [p.rule.order for p in resolve([a, b]) if p.kept] == [title.order]
        a.kept = b.kept = True


def test_table(spark, documents, edges):
    rows = edges + [(100 + i, t) for i, t in enumerate(TEXTS)] + [(7, "CC BY"), (7, "CC BY")]
    got = scan_licenses(documents(rows), ("doc_id", "lang")).collect()
    assert len(got) == len(rows)
    want = sorted((str(i), len(words(t)), len(base_places(t))) for i, t in rows)
    assert sorted((str(r.doc_id), r.n_words, sum(d.kind == "base" for d in r.detections)) for r in got) == want
    assert scan_licenses(documents([])).count() == 0
    only = scan_licenses(documents(rows).filter("doc_id = 110")).first()
    assert {d.label for d in only.detections if d.kept} == {"gpl-2.0-or-later"}


def test_query(spark, tmp_path, documents):
    from quayside.llm.queries import QUERIES

    rows = list(enumerate(TEXTS))
    documents(rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in QUERIES["op12_license_scan"](spark, str(tmp_path)).collect()}
    for i, text in rows:
        at = [p for p, _ in base_places(text)]
        r = got[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word) == (len(words(text)), len(at), min(at, default=None), max(at, default=None))
        assert r.base_labels == ",".join(sorted({label for _, label in base_places(text)}))
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1
    assert got[3].labels == "cc-by" and "mit" in got[9].labels and got[1].labels == ""
    assert QUERIES["op12_license_scan"](spark, str(tmp_path)).filter(F.col("n_words").isNull()).count() == 0
