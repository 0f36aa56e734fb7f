"""Operators on texts against plain versions, with nulls, empty tables, ties, long texts and other columns."""

from __future__ import annotations

import base64
import hashlib
import random
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from orderlens.llm import bpe, decontaminate, langid, licenses, repeats, secret_scan, simhash
from orderlens.llm.common import kth_smallest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, rows, schema=DOCS):
    """Rows of documents with a column whose name clashes with what operators use inside."""
    width = len(schema.split(","))
    rows = [(*row, *(None,) * (width - len(row)), 7) for row in rows]
    return spark.createDataFrame(rows, schema + ", k1 int")


def words(rng, n, vocabulary=None):
    syllables = ["th", "er", "on", "ing", "ti", "Ble", "ou", "é", "ß", "a"]
    make = lambda: "".join(rng.choices(syllables, k=rng.randint(1, 4)))
    return " ".join(rng.choice(vocabulary) if vocabulary else make() for _ in range(n))


# SimHash


def plain_fingerprint(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    found = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not found:
        return 0
    shingles = [" ".join(found[i : i + 3]) for i in range(max(1, len(found) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(nodes, linked):
    root = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in linked:
            low = min(root[a], root[b])
            changed |= root[a] != low or root[b] != low
            root[a] = root[b] = low
    return root


def test_fingerprints_follow_the_definition():
    rng = random.Random(1)
    texts = [None, "", " \n", "One", "one TWO", "a b c", "É x É y", words(rng, 900), "x " * 700]
    for text in texts:
        assert simhash.fingerprint(text) == plain_fingerprint(text)


@pytest.mark.parametrize("crowded", [2, 10_000])
def test_links_are_all_pairs_within_three_bits(spark, crowded):
    """Dense groups around few centres, looked up by one key or, where it is crowded, by two."""
    rng = random.Random(2)
    centres = [rng.getrandbits(64) for _ in range(6)] + [0, (1 << 64) - 1]
    values = set(centres)
    for centre in centres:
        for _ in range(25):
            flipped = centre
            for bit in rng.sample(range(64) if rng.random() < 0.5 else range(32), rng.randint(1, 5)):
                flipped ^= 1 << bit
            values.add(flipped)
    signed = lambda v: v - (1 << 64) if v >> 63 else v
    distinct = spark.createDataFrame([(signed(v),) for v in values], "fp long")
    got = {frozenset(r) for r in simhash.links(distinct, crowded=crowded).collect()}
    ordered = sorted(values)
    near = {frozenset((signed(a), signed(b))) for i, a in enumerate(ordered) for b in ordered[:i] if (a ^ b).bit_count() <= 3}
    assert got == near


def test_near_duplicates_equal_brute_force(spark):
    rng = random.Random(3)
    base = [words(rng, 200) for _ in range(8)]
    texts = base + base[:3] + [None, "", "   "]
    for text in base:
        for _ in range(4):
            parts = text.split()
            parts[rng.randrange(200)] = "changed"
            texts.append(" ".join(parts))
    rows = list(enumerate(texts, 10)) + [(None, base[0])]
    got = simhash.near_duplicates(frame(spark, rows)).collect()
    prints = {i: plain_fingerprint(t) for i, t in rows if i is not None}
    near = [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 3]
    root = components(prints, near)
    assert len(got) == len(rows)
    for r in got:
        expected = root[10] if r.doc_id is None else root[r.doc_id]
        assert r.component_id == expected
        assert r.doc_id is None or int(r.fingerprint, 16) == prints[r.doc_id]
    kept = simhash.distinct(frame(spark, [*rows, rows[0]]))
    assert kept.columns == [*(c.split()[0] for c in DOCS.split(", ")), "k1"]
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted(set(root.values()))
    assert simhash.near_duplicates(frame(spark, [])).count() == 0


def test_one_row_of_each_group_stays_whatever_its_id(spark):
    rng = random.Random(16)
    a, b, c, d = (words(rng, 80) for _ in range(4))
    rows = [(5, a), (5, b), (6, a), (7, b), (None, c), (None, c), (None, d), (8, d), (None, a), (5, a)]
    kept = [(r.doc_id, r.text) for r in simhash.distinct(frame(spark, rows)).collect()]
    assert sorted(kept, key=str) == sorted([(5, a), (5, b), (None, c), (8, d)], key=str)


# Decontamination


def distance_within(passage, text):
    """Fewest edits of the passage in any substring of the text."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(passage, 1):
        last, row = row, [i]
        for j, t in enumerate(text, 1):
            row.append(min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (p != t)))
    return min(row)


def test_passages_are_found_up_to_their_budget(spark):
    rng = random.Random(4)
    passages = [words(rng, n) for n in (8, 20, 45)] + ["short"]
    rows = []
    for i in range(60):
        passage = list(decontaminate.level(passages[i % 3]))
        allowed = decontaminate.budget(len(passage))
        for _ in range(rng.randint(0, allowed + 2)):
            at = rng.randrange(len(passage))
            change = rng.randrange(3)
            passage[at : at + (change != 1)] = "" if change == 0 else "q"
        rows.append((i, words(rng, 30) + "  " + "".join(passage).upper() + "\n" + words(rng, 30)))
    rows += [(100, None), (101, ""), (None, passages[2]), (102, "short"), (103, words(rng, 3000))]
    benchmark = spark.createDataFrame([*enumerate(passages), (9, None)], "item_id long, text string")
    got = decontaminate.contaminated(frame(spark, rows), benchmark, block_bytes=100).collect()
    found = {(r.doc_id, r.item_id): r for r in got}
    assert len(found) == len(got)
    texts = dict(rows)
    for doc_id, text in rows:
        for item, passage in enumerate(passages[:3]):
            levelled = decontaminate.level(passage)
            edits = distance_within(levelled, decontaminate.level(text or ""))
            expected = edits <= decontaminate.budget(len(levelled))
            assert ((doc_id, item) in found) == expected, (doc_id, item, edits)
            if expected:
                r = found[doc_id, item]
                assert r.edits == edits
                place = decontaminate.level(texts[doc_id][r.start : r.end])
                assert distance_within(levelled, place) == edits
    clean = decontaminate.clean(frame(spark, rows), benchmark, block_bytes=100)
    assert sorted(r.doc_id for r in clean.collect()) == sorted(i for i, _ in rows if i is not None and not any(k[0] == i for k in found))
    assert decontaminate.contaminated(frame(spark, rows), benchmark.limit(0)).count() == 0
    assert decontaminate.contaminated(frame(spark, []), benchmark).count() == 0


def test_parts_of_passages_and_short_passages_are_found(spark):
    rng = random.Random(15)
    item = decontaminate.level(words(rng, 90))[:394].strip()
    two_hundred = decontaminate.level(words(rng, 60))[:200].strip()
    changed = two_hundred.split(" ")
    for at in (3, 11, 19):
        changed[at] = "q" * len(changed[at])
    benchmark = [(1, item), (2, two_hundred), (3, "B-52 x"), (4, ""), (5, "xyz")]
    rows = [(0, f"so {item[:197]} and"), (1, f"so {item[197:]} and"), (2, "so " + " ".join(changed) + " and")]
    rows += [(3, "a b-52  X."), (4, "ab-52 x b-52 xy wxyz"), (5, words(rng, 300)), (6, "(xyz)")]
    for i in range(10, 40):
        start = rng.randrange(len(item) - 100)
        part = list(item[start : start + rng.randint(90, 190)])
        for _ in range(rng.randint(0, 8)):
            part[rng.randrange(len(part))] = rng.choice(["", "q", "qq"])
        rows.append((i, words(rng, 5) + " " + "".join(part) + "\n" + words(rng, 5)))
    got = decontaminate.contaminated(frame(spark, rows), spark.createDataFrame(benchmark, "item_id long, text string")).collect()
    found = {(r.doc_id, r.item_id): r for r in got}
    assert len(found) == len(got)
    assert {k for k in found if k[0] < 10} == {(0, 1), (1, 1), (2, 2), (3, 3), (6, 5)}
    assert found[0, 1].edits == found[1, 1].edits == 0 and "a b-52  X."[found[3, 3].start : found[3, 3].end] == "b-52  X"
    edits_of = []
    for doc_id, text in rows[7:]:
        levelled = decontaminate.level(text)
        parts = [item[a : a + 100] for a in range(0, len(item) - 99, 25)]
        edits = min(distance_within(part, levelled) for part in parts)
        assert ((doc_id, 1) in found) == (edits <= 5), (doc_id, edits)
        if edits <= 5:
            place = found[doc_id, 1]
            edits_of.append(edits)
            assert place.edits == edits
            stretch = re.sub(r"\s", " ", text[place.start : place.end].lower())
            assert min(distance_within(part, stretch) for part in parts) == edits
    assert 5 <= len(edits_of) < 30 and max(edits_of) > 2


# Byte-level BPE


@pytest.fixture(scope="module")
def tokenizer():
    import public_tokenizers
    import tiktoken

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return path, public_tokenizers.PATTERN, own


def test_ids_are_those_of_the_library(spark, tokenizer):
    path, pattern, own = tokenizer
    rng = random.Random(5)
    strange = ["\x1c x", "a  b", "  two  ", "\n\n x", "tab\t y ", "don't  we'll", "日本語 テキスト", "🙂🙂 a", "a" * 3000, " " * 50]
    texts = [None, "", *strange, words(rng, 3000)]
    texts += ["".join(rng.choices(" \n\tabAB1'é.,  ", k=200)) for _ in range(200)]
    rows = [*enumerate(texts), (0, None), (None, "x y")]
    got = bpe.encode_documents(frame(spark, rows), path, pattern, keep_ids=True).collect()
    assert len(got) == len(rows)
    by_id = defaultdict(set)
    for doc_id, text in rows:
        ids = own.encode_ordinary(text or "")
        digest = hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        by_id[doc_id].add((len(ids), digest, hashlib.sha256((text or "").encode()).hexdigest(), tuple(ids)))
    for r in got:
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256, tuple(r.ids)) in by_id[r.doc_id]
    assert bpe.encode_documents(frame(spark, []), path, pattern).count() == 0


def test_replay_where_a_merge_makes_a_lower_rank():
    """'ab' of rank 300 makes, with 'c', the token 'abc' of rank 260, learned another way."""
    ranks = {bytes([b]): b for b in range(256)} | {b"abc": 260, b"ab": 300, b"ca": 310, b"aa": 320, b"aaa": 330}
    replay = bpe.MergeReplay(ranks)
    rng = random.Random(6)
    found = ["".join(rng.choices("abc", k=rng.randint(0, 14))).encode() for _ in range(500)]
    for word, ids in zip(found, replay.encode(found)):
        assert np.frombuffer(ids, "<u4").tolist() == replay.encode_word(word)


# Language


def test_languages_are_learned_from_part_and_told_on_the_rest(spark):
    rng = random.Random(7)
    parts = {"en": "the ing tion of and".split(), "de": "der ung sch und ein".split(), "fr": "les eau oi des que".split()}
    parts["es"] = "los ción mente del que".split()
    rows = []
    for i in range(480):
        lang = list(parts)[i % 4]
        rows.append((i, " ".join("".join(rng.choices(parts[lang], k=2)) for _ in range(30)), lang))
    rows += [(1000, None, "en"), (1001, "", None), (1002, "12 !? 3", "fr"), (None, rows[0][1], "en"), (0, rows[0][1], "en")]
    rows.append((1003, "the tion of and ing " * 3000, None))
    got = langid.identify(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    import zlib

    truth = {r[0]: r[2] for r in rows}
    for r in got:
        assert 0 <= r.score <= 1
        if r.doc_id is not None:
            assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
    told = {r.doc_id: (r.lang_pred, r.score) for r in got}
    assert {told[i] for i in (1000, 1001, 1002)} == {("und", 0.0)}
    assert told[1003][0] == "en"
    held = [r for r in got if r.held_out and r.doc_id < 480]
    assert len(held) > 60 and sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.98 * len(held)
    kept = langid.determined(frame(spark, rows))
    assert {r.doc_id for r in kept.collect()} == set(truth) - {1000, 1001, 1002}
    english = {r.doc_id for r in langid.determined(frame(spark, rows), wanted=["en"]).collect()}
    assert english <= {r.doc_id for r in got if r.lang_pred == "en"} and 1003 in english
    assert langid.determined(frame(spark, rows), least_score=1.01).count() == 0
    unknown = [(1, "some text", None), (2, "", None)]
    assert [r.lang_pred for r in langid.identify(frame(spark, unknown)).collect()] == ["und", "und"]
    assert [r.doc_id for r in langid.determined(frame(spark, unknown)).collect()] == [1]
    assert langid.identify(frame(spark, [])).count() == 0


def test_every_labelled_row_is_learned_from(spark, monkeypatch):
    """Rows in several shards, a rare language in more than one of them, and none left out."""
    rng = random.Random(33)
    letters = {"en": "the and of", "nl": "het een van", "fr": "les des est", "xx": "zoq vuq wuq"}
    text = lambda lang: " ".join(rng.choices(letters[lang].split(), k=20))
    langs = ["en"] * 900 + ["nl"] * 500 + ["fr"] * 300 + ["xx"] * 30
    rows = [(i, text(lang), lang) for i, lang in enumerate(langs)] + [(9000, "12 34", "yy"), (9001, None, "zz")]
    docs = frame(spark, rows)
    monkeypatch.setattr(langid, "SHARD_ROWS", 256)
    dealt = []
    deal = langid._shards
    monkeypatch.setattr(langid, "_shards", lambda labelled, counts: dealt.append((labelled, deal(labelled, counts))) or dealt[0][1])
    model = langid.learn(docs)
    labelled, (n, shards) = dealt[0]
    of = {r.doc_id: r.shards for r in labelled.select("doc_id", shards.alias("shards")).collect()}
    learned = [r[0] for r in rows if zlib.crc32(str(r[0]).encode()) % 4 != 2]
    assert sorted(of) == sorted(learned) and n == -(-len(learned) // 256) > 4
    assert all(len(of[i]) == (n if langs[i] == "xx" else 1) for i in learned if i < 9000 and langs[i] in ("en", "xx"))
    assert {name for family in model.languages.values() for name in family} == set(letters)
    again = langid.learn(docs.repartition(7))
    assert (again.by_family == model.by_family).all()
    assert all(model.predict(text(lang))[0] == lang for lang in letters for _ in range(20))


# Licenses


def plain_licenses(text):
    found = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    places, base = [], set()
    for phrase, label in licenses.BASE.items():
        parts = phrase.split()
        at = [i for i in range(len(found)) if found[i : i + len(parts)] == parts]
        places += at
        base |= {label} if at else set()
    padded = " " + " ".join(found) + " "
    hits = []
    for rank, rule in enumerate(licenses.rules()):
        if set(rule.keywords) <= set(found):
            for m in re.finditer(rf"(?<= ){rule.pattern}(?= )", padded):
                hits.append((m.start(), m.end(), rule.priority, rank, rule.label))

    def hides(g, h):
        inside = g[0] <= h[0] and g[1] >= h[1]
        better = (g[2], g[0] - g[1], g[3]) < (h[2], h[0] - h[1], h[3])
        return inside and better

    kept = {h[4] for h in hits if not any(hides(g, h) for g in hits)}
    first, last = (min(places), max(places)) if places else (None, None)
    return len(found), len(places), first, last, ",".join(sorted(base)), ",".join(sorted(base | kept))


def written(pattern, rng):
    """A text that a rule's pattern matches, its choices drawn."""
    from re import _parser

    def text(items):
        out = ""
        for kind, value in items:
            kind = str(kind)
            if kind == "LITERAL":
                out += chr(value)
            elif kind == "BRANCH":
                out += text(rng.choice(value[1]))
            elif kind == "SUBPATTERN":
                out += text(value[3])
            elif kind == "MAX_REPEAT":
                out += "".join(text(value[2]) for _ in range(rng.randint(value[0], min(value[1], value[0] + 2))))
            elif kind == "NOT_LITERAL":
                out += "q"
            else:
                kind, value = rng.choice(value)
                out += chr(value) if str(kind) == "LITERAL" else chr(rng.randint(*value))
        return out

    return text(_parser.parse(pattern))


def test_every_license_rule_matches_texts_that_hold_its_keywords():
    rng = random.Random(25)
    rules = licenses.rules()
    assert len(licenses.BODIES) > 120 and len({r.pattern for r in rules}) > 400
    for rule in rules:
        for _ in range(10):
            text = written(rule.pattern, rng)
            assert re.fullmatch(rule.pattern, text), rule
            assert set(rule.keywords) <= set(text.split()), rule


LICENSE_TEXTS = {
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    'documentation files (the "Software"), to deal in the Software without restriction, including',
    "bsd,bsd-3-clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
    "that the following conditions are met: 3. Neither the name of the copyright holder nor the names of its contributors "
    "may be used to endorse or promote products derived from this software without specific prior written permission.",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
    "provided that the above copyright notice and this permission notice appear in all copies.",
    "apache-2.0 or mit": "Licensed under the MIT or Apache-2.0 license.",
    "gpl-2.0-or-later": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
    "Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later "
    "version.",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
    "distributed with this file, You can obtain one at",
    "unlicense": "This is free and unencumbered software released into the public domain.",
    "gpl-2.0 with syscall-note": "/* SPDX-License-Identifier: GPL-2.0 WITH Linux-syscall-note */",
}


def test_bodies_headers_and_dual_notices_are_labelled(spark):
    rows = list(enumerate(f"x {text} y" for text in LICENSE_TEXTS.values()))
    got = {r.doc_id: r for r in licenses.scan(frame(spark, rows)).collect()}
    for i, expected in enumerate(LICENSE_TEXTS):
        own = set(got[i].labels.split(",")) - set(got[i].base_labels.split(","))
        assert own == set(expected.split(",")), (expected, got[i].labels)
        assert got[i].score == 1.0


def test_licenses_equal_brute_force(spark):
    rng = random.Random(8)
    notices = [
        "Licensed under the Apache License, Version 2.0.", "Released under the MIT License.", "MIT License MIT License",
        "This work is licensed under the GNU General Public License, version 3.", "GNU Lesser General Public License v2.1",
        "Licensed under CC BY-NC 4.0.", "SPDX-License-Identifier: Apache-2.0", "All rights reserved.", "mit der license",
        "Copyright (c) 2020 Some One. All rights reserved.", "Creative Commons Attribution-ShareAlike 4.0 International License",
        "GNU General Public License version 2 or any later version", "BSD 3-Clause", "new BSD license", "CC0 1.0",
    ]
    texts = [None, "", "...", "KIT License", "MIT License", "mit license"]
    texts += [" ".join(rng.choice([words(rng, 5), rng.choice(notices)]) for _ in range(rng.randint(1, 8))) for _ in range(80)]
    texts.append(" ".join(notices) * 30)
    rows = [*enumerate(texts), (None, notices[0]), (1, "")]
    got = Counter(tuple(r)[:-1] for r in licenses.scan(frame(spark, rows)).collect())
    assert got == Counter((i, *plain_licenses(t)) for i, t in rows)
    assert len(licenses.rules()) > 200
    plan = licenses.scan(frame(spark, rows))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Exchange", plan)
    assert licenses.scan(frame(spark, [])).count() == 0


# Secrets


def plain_secrets(text):
    both = lambda word: "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)
    keys = "|".join(both(k).replace("_", "_?") for k in ("password", "passwd", "secret", "token", "api_key"))
    assign = re.compile(rf"""({keys})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    spans = [("assign", *m.span()) for m in assign.finditer(text) if len(m[2]) >= 12]
    spans += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    spans += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(spans, key=lambda s: (s[1], ("assign", "access", "hex").index(s[0])))


def secret(rng):
    kind = rng.randrange(5)
    if kind == 0:
        return rng.choice(["token = ", "PassWord:", 'api_key": "', "apikey='", "secret  =  "]) + "%040x" % rng.getrandbits(160)
    if kind == 1:
        return "AKIA" + "".join(rng.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", k=rng.choice([16, 13, 14])))
    if kind == 2:
        return "%0*x" % (rng.choice([15, 16, 32]), rng.getrandbits(60))
    return ["10.20.30.40", "token=short", "some.one.42@mail.example.org", "averylongbutordinaryword"][rng.randrange(4)]


def test_base_secrets_equal_the_patterns_and_stay(spark):
    rng = random.Random(9)
    texts = [None, "", "token=", "tokentoken=abcdefghijklmno", "toKen=abcdefghijklmno", "AKIAAKIA" + "A" * 14]
    texts += [" ".join(rng.choice([words(rng, 6), secret(rng)]) for _ in range(rng.randint(1, 9))) for _ in range(400)]
    texts.append(words(rng, 20_000) + " token = 0123456789abcdef0123 " + words(rng, 100))
    rows = [*enumerate(texts), (None, texts[7])]
    docs = frame(spark, rows)
    net = secret_scan.learn(docs)
    assert net is not None and 0 < net.threshold < 1
    texts_of = dict(rows)
    got = secret_scan.scan(docs, net).collect()
    assert len(got) == len(rows)
    for r in got:
        base = plain_secrets(texts_of[r.doc_id] or "")
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == s[0] for s in base) for k in ("assign", "access", "hex"))
        joined = secret_scan.join_spans(base)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        spans = r.spans.split(",") if r.spans else []
        assert [s for s in spans if not s.startswith("cnn")] == (joined.split(",") if joined else [])
    hidden = "here is %040X for you" % rng.getrandbits(160)
    learned = [s for s in secret_scan.find(hidden, net) if s[0] == "cnn"]
    assert all(hidden[a:b].isalnum() for _, a, b in learned)
    clean = secret_scan.redacted(docs, net)
    assert clean.columns == docs.columns and clean.count() == len(rows)
    for r in clean.collect():
        assert not plain_secrets(r.text or "") and r.n_chars == (None if r.text is None else len(r.text))
    assert secret_scan.learn(frame(spark, [])) is None
    assert secret_scan.scan(frame(spark, []), None).count() == 0


def test_candidates_and_findings_are_merged_as_each_pair_would_be():
    rng = random.Random(24)
    for _ in range(200):
        ends = sorted(rng.sample(range(200), 20))
        stretches = list(zip(ends[::2], ends[1::2]))
        spans = sorted((("hex", a, a + rng.randint(1, 40)) for a in rng.sample(range(200), rng.randint(0, 12))), key=lambda s: s[1])
        for start, end, inside in secret_scan._overlapping(stretches, spans):
            places = {i for _, a, b in spans for i in range(max(a, start), min(b, end))}
            assert places == {i for a, b in inside for i in range(a, b)}
        assert [(a, b) for a, b, _ in secret_scan._overlapping(stretches, spans)] == stretches


def test_a_long_text_of_findings_takes_time_in_proportion():
    text = " ".join("%032x" % i for i in range(30_000))
    started = time.perf_counter()
    found = secret_scan.find(text, None)
    assert len(found) == 30_000
    assert sum(1 for _ in secret_scan._overlapping(secret_scan.candidates(secret_scan._RUN.finditer(text)), found)) <= 30_000
    assert time.perf_counter() - started < 5


def test_the_network_tells_secrets_from_other_runs():
    """On rows it never saw: the asked recall, at few false alarms."""
    rng = random.Random(10)
    codes, labels = [], []
    for i in range(900):
        word = "%040x" % rng.getrandbits(160) if i % 2 else f"{rng.randint(1, 255)}.{rng.randint(10, 255)}.{rng.randint(100, 255)}.{rng.randint(10, 99)}"
        text = words(rng, 4) + " " + word + " " + words(rng, 4)
        start = text.index(word)
        codes.append(secret_scan._codes(text, start, start + len(word)))
        labels.append(bool(i % 2))
    codes, labels = np.array(codes), np.array(labels)
    net = secret_scan.train(codes[:600], labels[:600], np.arange(600) % 3 == 0)
    found = net.score(codes[600:]) >= net.threshold
    assert found[labels[600:]].mean() >= 0.9 and found[~labels[600:]].mean() <= 0.05


def test_findings_are_sampled_from_all_documents(spark):
    """Twelve findings in 8,000 documents: few in any sample of documents, enough in the table."""
    rng = random.Random(11)
    rows = [(i, "plain words and no more") for i in range(8000)]
    for i in range(12):
        rows[i * 600] = (i * 600, rng.choice(["token = ", "it was "]) + "%040x" % rng.getrandbits(160))
        rows[i * 600 + 1] = (None, f"from 10.20.{rng.randint(100, 255)}.{rng.randint(100, 255)} and on")
    rows += rows[:1] * 50 + [(9000, None), (9001, " ".join(f"{n}.mail.example.com" for n in range(10_000, 13_000)))]
    docs = frame(spark, rows)
    got = secret_scan.sampled(docs, 500)
    assert [s for s, _, _ in got].count(True) == 12 and len({k for _, k, _ in got}) == len(got) == 512
    assert secret_scan.sampled(docs.repartition(7), 500) == got
    net = secret_scan.learn(docs)
    assert net is not None
    hidden = "it was %013x_%013x_%013x for you" % tuple(rng.getrandbits(52) for _ in range(3))
    assert not plain_secrets(hidden)
    assert [s[0] for s in secret_scan.find(hidden, net)] == ["cnn"]
    few = docs.where("doc_id is null or doc_id >= 1200")
    assert secret_scan.learn(few) is not None
    assert secret_scan.learn(docs.where("doc_id > 2000")) is None


def test_every_finding_and_other_run_is_learned_from_or_calibrates(spark, monkeypatch):
    """More runs than any bound there was, in several shards, and all windows of a long one."""
    rng = random.Random(31)
    rows = [(i, "see %040x and %d.mail.example.com" % (rng.getrandbits(160), 10_000 + i)) for i in range(2400)]
    rows += rows[:7]
    docs = frame(spark, rows)
    monkeypatch.setattr(secret_scan, "SHARD_WINDOWS", 700)
    learned = []
    one_round = secret_scan._round
    monkeypatch.setattr(
        secret_scan, "_round", lambda net, shards, *rest: learned.append(shards) or one_round(net, shards, *rest)
    )
    net = secret_scan.learn(docs)
    assert net.held == (600, 600) and net.recall >= secret_scan.RECALL and net.precision >= 0.9
    assert len(learned) == secret_scan.ROUNDS
    dealt = learned[0].collect()
    assert len(dealt) == 6 and sum(map(len, (r.labels for r in dealt))) == sum(len(r.windows) for r in dealt) == 3600
    again = secret_scan.learn(docs.repartition(5))
    assert (again.kernel == net.kernel).all() and again.threshold == net.threshold
    hidden = "it was %013x_%013x_%013x for you" % tuple(rng.getrandbits(52) for _ in range(3))
    assert [s[0] for s in secret_scan.find(hidden, net)] == ["cnn"]
    text = "%04000x" % rng.getrandbits(16_000)
    ((label, _, windows),) = secret_scan._labelled(text)
    assert label and len(windows) == secret_scan.WINDOW * len(list(secret_scan._pieces(text, 0, len(text))))


def test_a_rank_among_all_values_is_exact(spark):
    rng = random.Random(32)
    values = [rng.choice([-1.0, 7.0, rng.gauss(0, 1)]) for _ in range(30_000)]
    rows = spark.createDataFrame([(v,) for v in [*values, None]], "v double").repartition(4).cache()
    values.sort()
    for k in (0, 1, 1499, 15_000, 29_999):
        assert kth_smallest(rows, "v", k) == values[k]


def test_the_threshold_keeps_the_asked_recall_where_labels_overlap():
    """One in twelve is a finding, and no character tells it: the calibrated probabilities are low."""
    rng = random.Random(13)
    texts = ["%040x" % rng.getrandbits(160) for _ in range(1200)]
    codes = np.array([secret_scan._codes(t, 0, len(t)) for t in texts])
    labels, held = np.arange(1200) % 12 == 0, np.arange(1200) % 5 == 0
    net = secret_scan.train(codes, labels, held)
    found = net.score(codes[held]) >= net.threshold
    assert net.threshold < 0.5 and net.held == (20, 220)
    assert found[labels[held]].mean() == net.recall >= secret_scan.RECALL
    assert net.precision == labels[held][found].mean()


def test_long_candidates_are_read_in_all_places(spark):
    """A key at any place of a path, a dotted token or a run without marks changes the score."""
    rng = random.Random(14)
    hexes = lambda n: "%0*x" % (n, rng.getrandbits(4 * n))
    slug = lambda n: "".join(rng.choices("aeilnorst-", k=n)).strip("-")
    rows = []
    for i in range(300):
        path = "/".join(["api", "v2", *(slug(9) for _ in range(rng.randint(2, 9))), "file.tar.gz"])
        rows.append((i, f"see {path} or {rng.choice(['token = ', 'it is '])}{hexes(rng.choice([24, 40]))} and {slug(14)}7"))
        at = rng.randrange(7, len(path) - 12)
        rows.append((1000 + i, f"at {path[:at]}/{hexes(32)}/{path[at:]} there"))
    net = secret_scan.learn(frame(spark, rows))
    found = {True: 0, False: 0}
    for _ in range(60):
        before, after = ("/".join(slug(9) for _ in range(rng.randint(6, 9))) for _ in range(2))
        for key in ("_".join(hexes(13) for _ in range(3)), slug(41)):
            text = f"at /api/v2/{before}/{key}/{after}/file.tar.gz there"
            assert not plain_secrets(text)
            found[key[13] == "_" and len(key) == 41] += bool(secret_scan.find(text, net))
    assert found[True] >= 50 and found[False] <= 20
    text = "x" * 5 + slug(500) + "7"
    covered = set()
    for a, b in secret_scan._pieces(text, 5, 506):
        assert b - a <= secret_scan.HEAD + secret_scan.TAIL
        covered |= set(range(a, b))
    assert covered >= set(range(5, len(text)))


# Repeats


def plain_repeats(texts):
    seen = Counter(t[i : i + 200] for t in texts for i in range(len(t) - 199))
    for t in texts:
        gone = np.zeros(len(t) + 1, int)
        for i in range(len(t) - 199):
            if seen[t[i : i + 200]] > 1:
                gone[i] += 1
                gone[i + 200] -= 1
        gone = np.cumsum(gone)[:-1] > 0
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        kept = np.frombuffer(t, np.uint8)[~gone].tobytes()
        yield len(t), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()


@pytest.mark.parametrize("crowded", [3, 2000])
def test_repeats_equal_brute_force(spark, crowded):
    rng = random.Random(11)
    shared = [words(rng, n) for n in (40, 70, 200, 25)]
    texts = [None, "", "x" * 199, "y" * 200, "z" * 450, "ab" * 150, words(rng, 300)]
    for _ in range(25):
        parts = [rng.choice([words(rng, rng.randint(1, 40)), rng.choice(shared)]) for _ in range(rng.randint(1, 5))]
        texts.append(" ".join(parts))
    texts += [texts[10], texts[11][:-3], texts[12][5:], "é" * 100, "é" * 99 + "è"]
    rows = [*enumerate(texts), (None, texts[13]), (14, texts[14])]
    got = repeats.remove_repeats(frame(spark, rows), crowded=crowded).collect()
    expected = Counter((i, *e) for (i, _), e in zip(rows, plain_repeats([(t or "").encode() for _, t in rows])))
    assert Counter(map(tuple, got)) == expected
    assert sum(e[1] > 0 for e in expected) > 10


def test_repeats_of_an_empty_table(spark):
    assert repeats.remove_repeats(frame(spark, [])).count() == 0


def test_texts_longer_than_a_chunk_have_the_same_anchors():
    rng = random.Random(12)
    data = bytes(rng.choices(b"abcdefgh ", k=repeats._CHUNK + 5000))
    windows = sum(int(n.sum()) for _, _, _, n in repeats.anchors(data))
    assert windows == len(data) - 199
    starts = np.concatenate([s for _, _, s, _ in repeats.anchors(data)])
    assert (np.diff(starts) > 0).all()


def test_matching_statistics_equal_brute_force():
    rng = random.Random(13)
    for _ in range(20):
        base = [bytes(rng.choices(b"ab\x00\xff", k=rng.randrange(1, 60))) for _ in range(4)]
        stretches = [b"".join(rng.choices(base, k=rng.randrange(1, 5))) for _ in range(rng.randrange(1, 8))]
        suffixes = [s[i:] for s in stretches for i in range(len(s))]

        def common(a, b):
            return next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))

        longest = [max([common(s, t) for j, t in enumerate(suffixes) if j != i], default=0) for i, s in enumerate(suffixes)]
        assert repeats.Index(stretches).matches().tolist() == longest
