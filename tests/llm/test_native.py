"""Surrogates, license scans and sharding."""

import random
import re
import zlib
from collections import Counter

import pytest

from spanloom.llm import licenses as L
from spanloom.llm import sharding as S
from spanloom.llm import surrogates as U

UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def luhn(s):
    t = 0
    for i, c in enumerate(reversed(s)):
        x = int(c) * (1 + i % 2)
        t += x - 9 * (x > 9)
    return t % 10 == 0


def test_surrogates_keep_type_format_and_identity(spark):
    rows = [
        (1, "mail Bob.7@mail3.example.com now, or bob.7@mail3.example.com."),
        (2, "call +1 (406) 555-0113 or +1-(406)-555-0113"),
        (3, "host 44.195.207.247 and card 4201974295263078 end"),
        (4, 'password=b7db7aa4a5fcc78305 token = "1beb58b8af68854f0e01b4ad40cdbb6ae7f578ae"'),
        (5, "Mrs. Jane Doe met Mr John Smith and г-н Иван Петров"),
        (6, "nothing here 123 45.6"), (7, None), (8, ""), (9, "bob.7@mail3.example.com"), (None, "44.195.207.247"),
    ]
    got = {r["doc_id"]: r for r in U.replace_private(spark.createDataFrame(rows, "doc_id long, text string"), key="k").collect()}
    a, b = re.findall(r"[\w.]+@[\w.]+[a-z]", got[1]["text"])
    assert a.lower() == b and a[0].isupper() and "bob" not in b and b.endswith(".com") and got[9]["text"] == b
    x, y = re.match(r"call (\+1 \(\d{3}\) \d{3}-\d{4}) or (\+1-\(\d{3}\)-\d{3}-\d{4})$", got[2]["text"]).groups()
    assert re.sub(r"\D", "", x) == re.sub(r"\D", "", y) != "14065550113"
    ip, card = re.match(r"host (\d\d\.\d{3}\.\d{3}\.\d{3}) and card (\d{16}) end$", got[3]["text"]).groups()
    assert all(int(o) < 256 for o in ip.split(".")) and luhn(card) and card[0] == "4" and card != "4201974295263078"
    assert got[None]["text"] == ip
    p, t = re.match(r'password=([0-9a-f]{18}) token = "([0-9a-f]{40})"$', got[4]["text"]).groups()
    assert p != "b7db7aa4a5fcc78305" and not t.startswith("1beb58b8")
    n = re.match(r"Mrs\. (\w+) (\w+) met Mr (\w+) (\w+) and г-н (\w+) (\w+)$", got[5]["text"]).groups()
    assert n[0] in U.NAMES["f", "latin"] and n[2] in U.NAMES["m", "latin"] and n[4] in U.NAMES["m", "cyrillic"]
    assert got[6]["text"] == rows[5][1] and got[7]["text"] is None and got[8]["text"] == ""
    assert [got[i]["n_entities"] for i in (1, 2, 3, 4, 5, 6, 7)] == [2, 2, 2, 2, 3, 0, 0]


def mod97(iban):
    s = iban.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97


def test_more_kinds_and_untitled_repeats(spark):
    rows = [
        (1, "Mr John Smith met John Smith, and John Smithers; Mr. Smith left"), (2, "555-123-4567 or (555) 123-4567 or +49 30 1234567"),
        (3, "ssn 123-45-6789."), (4, "pay DE89 3704 0044 0532 0130 00 or GB82WEST12345698765432"), (5, "at 2001:db8::8a2e:370:7334 and fe80:0:0:0:1:2:3:4"),
        (6, "at 10:30:15 or std::vector, 12-34-5678 and AB12 CDEF"), (7, "John Smith alone"),
    ]
    got = {r["doc_id"]: r for r in U.replace_private(spark.createDataFrame(rows, "doc_id long, text string"), key="k").collect()}
    a, b, c, d, e, f, g = re.match(r"Mr (\w+) (\w+) met (\w+) (\w+), and (John Smithers); Mr\. (\w+) (left)$", got[1]["text"]).groups()
    assert (a, b) == (c, d) and b == f and (a, b) != ("John", "Smith")
    x, y, z = re.match(r"(\d{3}-\d{3}-\d{4}) or (\(\d{3}\) \d{3}-\d{4}) or (\+\d\d \d\d \d{7})$", got[2]["text"]).groups()
    assert re.sub(r"\D", "", x) == re.sub(r"\D", "", y) != "5551234567" and re.sub(r"\D", "", z) != "49301234567"
    assert re.match(r"ssn \d{3}-\d{2}-\d{4}\.$", got[3]["text"]) and "123-45-6789" not in got[3]["text"]
    p, q = re.match(r"pay (DE\d\d \d{4} \d{4} \d{4} \d{4} \d\d) or (GB\d\d[A-Z]{4}\d{14})$", got[4]["text"]).groups()
    assert mod97(p) == mod97(q) == 1 and "3704" not in p
    assert re.match(r"at [0-9a-f]{4}:[0-9a-f]{3}::[0-9a-f]{4}:[0-9a-f]{3}:[0-9a-f]{4} and [0-9a-f]{4}(:[0-9a-f]){7}$", got[5]["text"]) and "db8" not in got[5]["text"]
    assert got[6]["text"] == rows[5][1] and got[7]["text"] == rows[6][1]
    assert [got[i]["kinds"] for i in range(1, 7)] == ["name", "phone", "ssn", "iban", "ip6", ""]


def test_surrogates_are_distinct_and_not_real(spark):
    rows = [(i, f"{a}.{b}.1.1") for i, (a, b) in enumerate((a, b) for a in range(1, 10) for b in range(1, 10))]
    e = spark.createDataFrame([("ip", t) for _, t in rows], "kind string, canon string")
    got = [r["surrogate"] for r in U.assign_surrogates(e, "k").collect()]
    assert len(set(got)) == len(rows) and not set(got) & {t for _, t in rows}


def test_surrogates_depend_on_the_key(spark):
    d = spark.createDataFrame([(1, "x@y.example.com")], "doc_id long, text string")
    assert U.replace_private(d, key="a").first()["text"] != U.replace_private(d, key="b").first()["text"]


def test_surrogates_edges(docs, corpus, empty):
    got = {r["doc_id"]: r["text"] for r in U.replace_private(docs, key="k").collect()}
    assert got == dict(corpus)
    assert U.replace_private(empty, key="k").collect() == []


def brute_license(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(UP))
    at = {k: [i for i in range(len(w)) if tuple(w[i : i + len(p)]) == p] for k, p in L.PHRASES.items()}
    all_ = sum(at.values(), [])
    base = sorted(k for k, v in at.items() if v)
    more, best = set(), 0.0
    for line in (text or "").split("\n"):
        own = set(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", line.translate(UP)))
        for label, t in L.TEMPLATES:
            want = set(t.split())
            if len(want & own) >= 0.9 * len(want) - 1e-9:
                more.add(label)
                best = max(best, len(want & own) / len(want))
    return len(w), len(all_), min(all_, default=None), max(all_, default=None), ",".join(base), ",".join(sorted({*base, *more})), 1.0 if all_ else best


def test_licenses_equal_brute_force(spark, docs, corpus, empty):
    extra = [
        (9001, "mit license MIT LICENSE\nLicensed under CC BY-NC 4.0."), (9002, "mit\nlicense"), (9003, "This file: permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (x)"),
        (9004, "GNU Lesser General Public License version 2: licensed under the"), (9005, "license " * 5), (None, "the Apache License"), (9001, "other text"),
    ]
    all_ = docs.select("doc_id", "text").unionByName(spark.createDataFrame(extra, "doc_id long, text string"))
    got = Counter((r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"], r["labels"], r["score"]) for r in L.scan_licenses(all_).collect())
    assert got == Counter((i, *brute_license(t)) for i, t in [*corpus, *extra])
    assert L.scan_licenses(empty).collect() == []


def test_notices_over_any_number_of_lines_equal_their_sql(spark):
    import duckdb

    from spanloom.llm.queries import licenses_sql

    isc = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted".split()
    wrap = lambda words, k, sep="\n": sep.join(" ".join(words[i : i + k]) for i in range(0, len(words), k))
    filler = "these lines have words but no notice at all "
    texts = [wrap(isc, k) for k in (1, 2, 3, 5, 9)] + [wrap(isc, 2, "\n\n\n"), filler + "\n" + wrap(isc, 3) + "\n" + filler * 3, filler * 20 + wrap(isc, 9) + " " + filler * 20]
    texts += [wrap(isc, 3).replace("\n", "\n" + filler * 9 + "\n"), wrap(isc[:-4], 3), wrap(isc, 1) + "\n" + wrap(isc, 2), "Licensed under\nthe Apache\nLicense\nVersion 2", "", None, "\n\n"]
    rows = [*enumerate(texts)]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    want = {r[0]: r[1:] for r in con.execute(licenses_sql()).fetchall()}
    got = L.scan_licenses(spark.createDataFrame(rows + rows[:3], "doc_id long, text string")).collect()
    assert len(got) == len(rows) + 3
    for g in got:
        assert tuple(g)[1:] == want[g.doc_id], texts[g.doc_id]
    labels = {g.doc_id: g.labels for g in got}
    assert all(labels[i] == "isc" for i in range(8)) and labels[8] == "" and labels[11] == "apache"


def test_schedule_is_longest_first():
    got = S.schedule([(7, 2, 14), (5, 1, 5), (4, 2, 8), (3, 3, 9)], 3)
    load = Counter()
    for key, lo, hi, shard in got:
        load[shard] += key * (hi - lo)
    assert sum(load.values()) == 36 and max(load.values()) - min(load.values()) <= 3


def test_bulk_equals_one_by_one():
    r = random.Random(3)
    for _ in range(20):
        classes = [(s, n, s * n) for s, n in {r.randrange(1, 90): r.randrange(1, 400) for _ in range(6)}.items()]
        load = Counter({s: 0 for s in range(5)})
        for key, lo, hi, shard in S.schedule(classes, 5):
            load[shard] += key * (hi - lo)
        plain = [0] * 5
        for s, n, _ in sorted(classes, reverse=True):
            for _ in range(n):
                plain[plain.index(min(plain))] += s
        assert sorted(load.values()) == sorted(plain)


def test_shards(docs, corpus, empty):
    rows = S.assign_shards(docs, shards=4).collect()
    text = dict(corpus)
    assert len(rows) == len(corpus)
    shard_of = {}
    for r in rows:
        t = text[r["doc_id"]] or ""
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(t.encode()) + 1, zlib.crc32(t.encode()), "bytes", None)
        assert shard_of.setdefault(t, r["shard"]) == r["shard"]
    for s in range(4):
        own = sorted(r["slot"] for r in rows if r["shard"] == s)
        assert own == list(range(len(own)))
    assert S.assign_shards(empty).collect() == []


def test_sizes_are_near_equal(spark):
    r = random.Random(1)
    d = spark.createDataFrame([(i, "x" * int(r.paretovariate(1.2) * 20) + str(i)) for i in range(3000)], "doc_id long, text string")
    load, largest = Counter(), 0
    for x in S.assign_shards(d, shards=16).collect():
        load[x["shard"]] += x["size"]
        largest = max(largest, x["size"])
    rest = sorted(load.values())[:-1] if largest > 0.9 * max(load.values()) else sorted(load.values())
    assert max(rest) < 1.02 * min(rest)


@pytest.mark.parametrize("text, kind", [("a.b@c.example.org", "email"), ("10.0.0.1", "ip"), ("+1 (456) 555-2186", "phone"), ("4404 1894 9746 0879", "card"), ("token=abcdef123", "secret")])
def test_kinds(spark, text, kind):
    d = spark.createDataFrame([(1, f"see {text}, ok")], "doc_id long, text string")
    got = U.replace_private(d, key="k").first()
    assert got["kinds"] == kind and text not in got["text"] and got["text"].startswith("see ") and got["text"].endswith(", ok")


SHORTEST = ["a@b.co", "token=abcdefgh", "api_key=sk-live-abcdefgh", "password: ab/cdefghij", "secret:--------", "8.8.8.8", "400000000000000", "1(23)456789", "+12345678", "Mr Xa", "Mrs Xa", "Ms Xa", "Herr Xa", "Frau Xa", "Señora Xa", "Señor Xa", "Monsieur Xa", "Madame Xa", "г-н Ия", "г-жа Ия"]


def test_a_text_of_one_entity_is_found(spark):
    d = spark.createDataFrame(list(enumerate(SHORTEST)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in U.replace_private(d, key="k").collect()}
    assert [t for i, t in enumerate(SHORTEST) if got[i]["n_entities"] != 1 or got[i]["text"] == t] == []


def test_long_and_short_mentions_of_a_person_agree(spark):
    d = spark.createDataFrame([(1, "Mr John Smith"), (2, "Mr. Smith"), (3, "Mrs Smith"), (4, "Mr Jack Smith"), (5, "г-н Иван Петров"), (6, "г-н Петров")], "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in U.replace_private(d, key="k").collect()}
    last = {i: t.split()[-1] for i, t in got.items()}
    assert last[1] == last[2] == last[3] == last[4] != "Smith" and last[5] == last[6] != "Петров" and len(set(got.values())) == 6


def test_formats_do_not_run_out(spark):
    rows = [("ip", f"{a}.{b}.{c}.{d}") for a in range(1, 10) for b in range(1, 10) for c in range(1, 10) for d in range(1, 10)]
    rows += [("name", f"Mr X{chr(97 + i // 26)}{chr(97 + i % 26)} Smith") for i in range(300)] + [("secret", "--------"), ("email", "a@b.co")]
    rows += [("email", f"{chr(97 + i // 26)}@{chr(97 + i % 26)}.co") for i in range(676)]
    rows = sorted(set(rows))
    e = spark.createDataFrame(rows, "kind string, canon string")
    got = U.assign_surrogates(e, "k").collect()
    assert len(got) == len(rows) == len({(r["kind"], r["surrogate"]) for r in got}) and not {(r["kind"], r["surrogate"]) for r in got} & set(rows)


def test_wrapped_notices_are_found(spark):
    wrapped = {
        1: ("apache", "# you may not use this file except in compliance\n# with the License. You may obtain a copy\n# of the License at"),
        2: ("bsd", "Redistribution and use in source and binary forms, with or\nwithout modification, are permitted provided that the following\nconditions are met:"),
        3: ("isc", "Permission to use, copy, modify, and/or\ndistribute this software for any purpose with or\nwithout fee is hereby granted"),
        4: ("unlicense", "This is free and unencumbered software released\ninto the public domain."),
    }
    rows = [(i, f"x\n{t}\ny") for i, (_, t) in wrapped.items()] + [(9, wrapped[4][1].replace("\n", " ") + "\n\nof the and"), (10, "This is free and unencumbered\n" + "a\n" * 6 + "software released into the public domain")]
    rows += [(11, rows[-1][1].replace("a\n", "a b c\n"))]
    got = {r["doc_id"]: (r["labels"], r["n_blocks"]) for r in L.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {**{i: (label, 1) for i, (label, _) in wrapped.items()}, 9: ("unlicense", 1), 10: ("unlicense", 1), 11: ("", 0)}


def brute_entities(text):
    """Kinds and surfaces, by another regex engine, place by place."""
    import regex

    out, at = [], 0
    while at <= len(text):
        hits = [(m.start(), k, m[0]) for k, p in U.PATTERNS.items() if (m := regex.compile(p).search(text, at))]
        if not hits:
            break
        first = min(h[0] for h in hits)
        _, kind, surface = next(h for h in hits if h[0] == first)
        out.append((kind, surface))
        at = first + len(surface)
    return out


def test_surrogates_equal_brute_force(spark, docs, corpus):
    """The same entities as a plain scan finds; between them nothing changes; equal entities, and only they, agree."""
    import regex

    rows = [(1000 + i, t) for i, t in enumerate([
        "dns 8.8.8.8 and 1.1.1.1", "password=ab-cdefgh1", "Mr John Smith met Mr. Smith and Mrs Smith", "Herr Müller-Lüdenscheid rief an", "Ms O'Neil left",
        "Dr Anna Weber, Prof. Weber", "г-н Иванов и г-жа Анна Иванова", "κ. Παπάς και κα Μαρία Παπά", "mail a@b.org or A@B.org", "+4915112345678 or +49 (151) 1234 5678",
        "4111 1111 1111 1111; 4111-1111-1111-1111", "Señora Nuñez y Sra García", "token: abcdefgh", "nobody here", "",
    ])]
    d = docs.select("doc_id", "text").unionByName(spark.createDataFrame(rows, "doc_id long, text string"))
    got = {r["doc_id"]: r for r in U.replace_private(d, key="k").collect()}
    agree, values = {}, {}
    for i, t in [*corpus, *rows]:
        found = brute_entities(t or "")
        assert got[i]["n_entities"] == len(found) and got[i]["kinds"] == ",".join(sorted({k for k, _ in found})), t
        parts, at = [], 0
        for _, surface in found:
            j = t.index(surface, at)
            parts.append(t[at:j])
            at = j + len(surface)
        if not found:
            assert got[i]["text"] == t
            continue
        m = re.fullmatch("(.+?)".join(map(re.escape, [*parts, t[at:]])), got[i]["text"], re.S)
        assert m, (t, got[i]["text"])
        for (kind, surface), new in zip(found, m.groups()):
            assert new != surface
            canon = regex.sub(r"\D", "", surface) if kind in ("phone", "card") else surface.lower() if kind == "email" else surface.replace(".", "") if kind == "name" else surface
            new = regex.sub(r"\D", "", new) if kind in ("phone", "card") else new.lower() if kind == "email" else new.replace(".", "") if kind == "name" else new
            assert agree.setdefault((kind, canon), new) == new and values.setdefault(new, canon) == canon
    family = lambda i, k: got[i]["text"].replace(",", "").split()[k]
    assert family(1002, 2) == family(1002, 5) == family(1002, 8)
    assert family(1005, 2) == family(1005, 4) and "-" in family(1003, 1) and family(1004, 1).startswith("O'")


def test_codes_are_hmac(spark):
    import hashlib
    import hmac

    from pyspark.sql import functions as F

    for key in (b"k", b"x" * 100):
        row = spark.range(1).select(U.hmac_sha256(key, F.lit("message ü")).alias("h")).first()
        assert row["h"] == hmac.new(key, "message ü".encode(), hashlib.sha256).hexdigest()


MIT_TEXT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in
all copies or substantial portions of the Software."""


def test_whole_license_texts_are_found(spark):
    short = " ".join(MIT_TEXT.split()[:20])
    narrow = "\n".join(MIT_TEXT.replace("\n", " ").split(", "))
    rows = [(1, "code\n" + MIT_TEXT + "\nmore"), (2, MIT_TEXT.replace("\n", " ")), (3, narrow), (4, short), (5, "nothing of it")]
    out = L.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string"), templates=[("whole-mit", MIT_TEXT)], run=12)
    assert {r["doc_id"]: r["labels"] for r in out.collect()} == {1: "whole-mit", 2: "whole-mit", 3: "whole-mit", 4: "", 5: ""}
