import hashlib
import random
import re
import textwrap
from collections import defaultdict

import pytest
import xxhash

from sparkloom.llm import license_scan, mixing, url_filters

from . import cases

PAGES = "page_id long, url string, html string, node string, component string, key string, verdict string"


def judged(spark, rows, **options):
    pages = spark.createDataFrame([(*r, "a", "b", "c", "d") for r in rows], PAGES)
    return {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filters.filter_urls(pages, **options).collect()}


def test_rules_fit_hosts_subdomains_and_paths(spark):
    got = judged(
        spark,
        [
            (1, "https://A.Example.NET/en/x?q#f", ""),
            (2, "http://example.net/de/", None),
            (3, "http://example.net", None),
            (4, "http://notexample.com/de/", ""),
            (5, "http://m.example.com/de/1", ""),
            (6, "http://m.example.com/fr/1", ""),
            (7, "http://x.org/fr/", ""),
            (8, None, "<link rel=canonical href='http://a.net/'>"),
            (9, "no scheme", None),
            (10, "", ""),
            (11, "http://", ""),
            (12, "http://a.net?x://y.org/fr/", ""),
        ],
    )
    assert got[1] == ("a.example.net", "/en/x", "example.net/en/", "allow")
    assert got[2][2:] == ("net/", "block")
    assert got[3] == ("example.net", "", None, "allow")
    assert got[4][2:] == (None, "allow")
    assert got[5][2:] == ("example.com/de/", "block")
    assert got[6][2:] == (None, "allow")
    assert got[7][2:] == ("org/fr/", "allow")
    assert got[8] == got[9] == got[10] == got[11] == ("", "", None, "allow")
    assert got[12][:2] == ("a.net", "")


def test_links_carry_blocks_and_allows_win(spark):
    link = '<html><LINK href="{}" rel="canonical"></html>'.format
    refresh = '<meta http-equiv="refresh" content="0; url={}">'.format
    rows = [
        (1, "http://a.com/1", link("http://b.com/1")),
        (2, "https://b.com/1#x", refresh("//c.com/1")),
        (3, "http://c.com/1", link("http://bad.net/z")),
        (4, "http://d.com/x/y", link("../z")),
        (5, "http://e.com/x", link("http://bad.net/q")),
        (6, "http://f.org/fr/x", link("http://e.com/x")),
        (7, "http://g.com/1", "<a rel='canonical' href='http://bad.net/'>"),
        (8, "http://h.com/dir/p?q=1", refresh("/dir/q")),
        (9, "http://h.com/dir/q", link("r")),
        (10, "http://h.com/dir/r", link("http://bad.net/")),
        (11, "http://a.com/1", ""),
        (12, "http://bad.net/z", ""),
    ]
    got = {k: v[3] for k, v in judged(spark, rows).items()}
    blocked = {k for k, v in got.items() if v == "block"}
    assert blocked == {1, 2, 3, 8, 9, 10, 11, 12}
    known = spark.createDataFrame([("http://g.com/1", "http://bad.net/z"), (None, "x")], "source string, target string")
    assert judged(spark, rows, links=known)[7][3] == "block"
    assert url_filters.filter_urls(spark.createDataFrame([], PAGES)).count() == 0


def test_groups_of_addresses_equal_the_sql(spark, tmp_path):
    """Random links of three kinds, a hub, chains, rules along them, nulls, repeated rows and very long addresses."""
    import duckdb

    rng = random.Random(3)
    hosts = ["a.com", "b.com", "M.example.com", "example.net", "x.example.net", "bad.net", "y.org", "z.io"]
    address = lambda: f"{rng.choice(['http', 'https'])}://{rng.choice(hosts)}{rng.choice(['', '/', '/en/', '/de/', '/fr/'])}{rng.randint(0, 60)}"
    link = ['<link rel="canonical" href="{}">', "<p><LINK HREF='{}' REL=canonical /></p>", '<meta http-equiv=refresh content="0; URL={}">', "<a href='{}'>"]
    rows = [(i, address(), rng.choice(link).format(rng.choice([address(), address(), f"/fr/{i % 50}", f"//{rng.choice(hosts)}/q{i % 9}", "next"]))) for i in range(300)]
    rows += [(1000 + i, f"http://hub.com/{i}", link[0].format("http://hub.com/")) for i in range(400)] + [(1500, "http://hub.com/", link[2].format("http://bad.net/all"))]
    rows += [(1600 + i, f"http://chain.com/{i}", link[0].format(f"/{i + 1}")) for i in range(40)] + [(1650, "http://chain.com/40", link[0].format("http://y.org/fr/40"))]
    rows += [(1700, None, "x"), (1701, "no scheme", link[0].format("http://bad.net/")), (1702, "", None), rows[0], rows[0], (None, address(), ""), (1703, "http://long.com/" + "p/" * 50_000, "<b>" * 100_000 + link[0].format("http://bad.net/"))]
    folder = f"{tmp_path}/pages.parquet"
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    pages.write.parquet(folder)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{folder}/*.parquet'")
    columns = ["page_id", "host", "path", "rule", "verdict"]
    want = con.execute(f"SELECT {', '.join(columns)} FROM ({url_filters.ORACLE})").fetchall()
    assert sorted(map(repr, map(tuple, url_filters.filter_urls(pages).select(columns).collect()))) == sorted(map(repr, want))
    verdicts = {r[0]: r[4] for r in want}
    assert {verdicts[1000 + i] for i in range(400)} == {"block"} and {verdicts[1600 + i] for i in range(40)} == {"allow"}


def test_license_rules_read_sequences(spark):
    s = license_scan.SENTENCES
    texts = [
        "Prose. " + s["mit-grant"] + ":\n\n" + s["mit-notice"] + ".\n" + s["mit-as-is"] + ". " + s["mit-liability"] + ".",
        "x\nRELEASED under  the MIT  license.\nAll Rights Reserved.",
        "/* Licensed under the Apache License, Version 2.0 (the \"License\");\n * you may not use this file except in compliance with the License. */",
        s["gpl-free"] + ": " + s["gpl2-terms"] + ".",
        "reserved all rights. the licensed software",
        "Licensed under CC BY-NC 4.0.",
        s["mpl2"] + ".",
        None,
        "",
    ]
    docs = spark.createDataFrame([(i, t, "x", "y") for i, t in enumerate(texts)] + [(None, texts[5], "x", "y"), (5, texts[5], "", "")], "doc_id long, text string, ids string, license string")
    got = sorted((repr(r.doc_id), r.licenses, r.license) for r in license_scan.scan_licenses(docs).collect())
    assert got == sorted(
        [
            ("0", "MIT", "MIT"),
            ("1", "MIT,all-rights-reserved", "MIT"),
            ("2", "Apache-2.0", "Apache-2.0"),
            ("3", "GPL-2.0-or-later", "GPL-2.0-or-later"),
            ("4", "", None),
            ("5", "CC-BY-NC-4.0", "CC-BY-NC-4.0"),
            ("5", "CC-BY-NC-4.0", "CC-BY-NC-4.0"),
            ("6", "MPL-2.0", "MPL-2.0"),
            ("7", "", None),
            ("8", "", None),
            ("None", "CC-BY-NC-4.0", "CC-BY-NC-4.0"),
        ]
    )
    assert license_scan.scan_licenses(spark.createDataFrame([], docs.schema)).count() == 0
    assert license_scan.scan_licenses(cases.documents(spark)).where("n_matched > 0").count() == 0


def test_wrapped_licenses_are_found(spark):
    s = license_scan.SENTENCES
    mit = f"{s['mit-grant']}:\n\n{s['mit-notice']}.\n\n{s['mit-as-is']}. {s['mit-liability']}."
    bsd = f"Copyright (c) 2020, A. Body. All rights reserved.\n\n{s['bsd-grant']}:\n\n1. {s['bsd-source']}.\n\n2. {s['bsd-binary']}.\n\n3. {s['bsd-endorse']}."
    gpl = f"{s['gpl-free']}: {s['gpl3-terms']}.\n\n{s['gpl-hope']}"
    apache = f"{s['apache-header']}; {s['apache-comply']}. {s['apache-copy']}\n\n  http://www.apache.org/licenses/LICENSE-2.0\n\n{s['apache-basis']}."

    def wrapped(text, leader, width, end="\n"):
        lines = [x for part in text.split("\n\n") for x in [*textwrap.wrap(part, width), ""]]
        return end.join(leader + x for x in lines)

    want = [(mit, 4, "MIT"), (bsd, 5, "BSD-3-Clause"), (gpl, 3, "GPL-3.0-or-later"), (apache, 4, "Apache-2.0"), (s["isc-grant"], 1, "ISC"), (s["mpl2"] + ".", 2, "MPL-2.0")]
    rows, told = [], {}
    for text, n, name in want:
        for leader in ("", " * ", "// ", "# ", ";; ", "dnl ", "REM "):
            for width, end in ((72, "\n"), (80, "\r\n"), (30, "\n")):
                told[len(rows)] = (n, name)
                rows.append((len(rows), "The " + name + " notice" + end + wrapped(text, leader, width, end)))
    for text in ("Permission is hereby\n\ngranted, free of charge", s["isc-grant"].replace(" ", "\n\n"), s["mit-released"] + "\nof old", "x " + s["isc-grant"].replace("software", "hardware")):
        told[len(rows)] = (1, "MIT") if text.startswith("Released") else (0, None)
        rows.append((len(rows), text))
    got = {r.doc_id: (r.n_matched, r.license) for r in license_scan.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == told


def brute_read(ids, rules):
    """Licences whose codes stand in ``ids`` in order, by a plain reader."""
    found = []
    for name, codes in rules:
        rest = iter(ids)
        if all(c in rest for c in codes) and name not in found:
            found.append(name)
    return found


def test_ordered_rules_equal_a_plain_reader(spark):
    rng = random.Random(9)
    sentences = {c: f"the {w} licence sentence" for c, w in zip("abcdef", ("first", "second", "third", "fourth", "fifth", "sixth"), strict=True)}
    rules = [(f"L{i}", tuple(rng.choices("abcdef", k=rng.randint(1, 4)))) for i in range(25)]
    drawn = [rng.choices("abcdef", k=rng.randint(0, 9)) for _ in range(200)]
    docs = spark.createDataFrame([(i, "\n".join(rng.choice(["", "Between them stands prose. "]) + sentences[c] + "." for c in d)) for i, d in enumerate(drawn)], "doc_id long, text string")
    got = {r.doc_id: r for r in license_scan.scan_licenses(docs, sentences, rules).collect()}
    for i, d in enumerate(drawn):
        want = brute_read(d, rules)
        assert (got[i].sentence_ids, got[i].licenses, got[i].license) == (",".join(d), ",".join(want), want[0] if want else None)


def test_licenses_in_very_long_texts(spark):
    s = license_scan.SENTENCES
    many = s["mit-grant"] + ".\n" + (s["mit-released"] + ".\n" + s["all-rights"] + ".\n") * 50_000 + s["mit-as-is"] + "."
    texts = [many, "dnl " * 100_000 + s["mit-released"], "\n" + "rem \U0001f600 " * 100_000 + "\n" + s["mit-released"], "* " * 100_000 + "\n" + s["isc-grant"], "license. " * 100_000, "license " + "\n \n" * 100_000]
    got = [(r.n_matched, r.licenses) for r in license_scan.scan_licenses(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()]
    assert got == [(100_002, "MIT,all-rights-reserved"), (1, "MIT"), (1, "MIT"), (1, "ISC"), (0, ""), (0, "")]


def brute_targets(sizes, weights=(5, 2, 1), most=3, share=1.0):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    total, capped, target = sum(sizes.values()) * share, set(), {}
    while True:
        free = [s for s in names if s not in capped]
        rest = total - sum(most * sizes[s] for s in capped)
        target = {s: most * sizes[s] if s in capped else rest * w[s] / sum(w[x] for x in free) for s in names}
        over = {s for s in free if target[s] > most * sizes[s]}
        if not over:
            return target
        capped |= over


def brute_mix(rows):
    """Targets, and the sorted (doc_id, size, taken) of all rows, by one walk along each source's sorted rows."""
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    by = defaultdict(lambda: defaultdict(list))
    for doc, text, source in rows:
        by[source][int(hashlib.md5(f"mix:{'' if doc is None else doc}".encode()).hexdigest()[:15], 16)].append((doc, size(text), xxhash.xxh64_intdigest((text or "").encode(), 42) & ((1 << 60) - 1)))
    target = brute_targets({s: sum(n for v in docs.values() for _, n, _ in v) for s, docs in by.items()})
    out = []
    for source, docs in by.items():
        words = sum(n for v in docs.values() for _, n, _ in v)
        copies = int(target[source] // words) if words else 0
        budget, crossed = target[source] - copies * words, False
        for h in sorted(docs):
            for doc, n, _ in sorted(docs[h], key=lambda r: r[2]):
                taken = copies + (not crossed and (n <= budget or n - budget < budget))
                crossed |= n > budget
                budget -= n
                out.append(repr((doc, n, taken * n)))
    return target, sorted(out)


def test_mixing_equals_brute_force(spark):
    docs = cases.documents(spark)
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    target, want = brute_mix(rows)
    got = mixing.mix(docs)
    found = sorted(repr((r.doc_id, r.size, r.taken)) for r in got.collect())
    assert found == want
    assert sorted({r.target for r in got.collect()}) == pytest.approx(sorted(set(target.values())))
    assert got.where("taken > 3 * size").count() == 0
    assert found == sorted(repr((r.doc_id, r.size, r.taken)) for r in mixing.mix(docs.repartition(7)).collect())
    assert mixing.mix(cases.empty(spark)).count() == 0


@pytest.mark.parametrize("kind", ["null ids", "both"])
def test_mixing_reaches_targets_where_ids_do_not_tell_rows_apart(spark, kind):
    rng = random.Random(2)
    rows = [(i, " ".join("w" * rng.randint(1, 9) for _ in range(rng.randint(1, 30))), "b") for i in range(80)]
    for i in range(200):
        text = "one two three" if kind == "same rows" or kind == "both" and i % 2 else " ".join(f"w{i}" for _ in range(1 + i % 7))
        rows.append((None if kind == "null ids" or kind == "both" and i % 3 else 7, text, "a"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    got = mixing.mix(docs).collect()
    for source, longest in (("a", 7), ("b", 30)):
        ids = {r[0] for r in rows if r[2] == source}
        mine = [r for r in got if (r.doc_id in ids) and r.source_size == sum(len(t.split()) for _, t, s in rows if s == source)]
        assert abs(sum(r.taken for r in mine) - mine[0].target) <= longest / 2
    assert all(r.taken <= 3 * r.size for r in got)
    again = mixing.mix(docs.repartition(3)).collect()
    assert sorted(repr(tuple(r)) for r in got) == sorted(repr(tuple(r)) for r in again)
    out = mixing.mixed_documents(docs.withColumn("__sl_n", docs.text))
    assert out.select(mixing.word_count(out.text).alias("n")).agg({"n": "sum"}).first()[0] == sum(r.taken for r in got)


def test_targets_of_many_sources(spark):
    rng = random.Random(5)
    for share in (1.0, 0.5):
        sizes = {f"s{i:04d}": int(rng.paretovariate(0.6)) for i in range(3000)} | {None: 5, "z": 0}
        got = {r.source: r.target for r in mixing.source_targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long").repartition(6), share=share).collect()}
        assert got == pytest.approx(brute_targets(sizes, share=share))


def test_mixed_documents_repeat_whole_rows(spark):
    docs = cases.documents(spark)
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns and out.schema.simpleString() == docs.schema.simpleString()
    words = out.select(mixing.word_count(out.text).alias("n")).agg({"n": "sum"}).first()[0]
    assert words == mixing.mix(docs).agg({"taken": "sum"}).first()[0]
    assert out.count() == mixing.mix(docs).where("size > 0").agg({"copies": "sum"}).first()[0]
    assert mixing.mixed_documents(cases.empty(spark)).count() == 0


def test_single_source_takes_everything_once(spark):
    docs = spark.createDataFrame([(i, "a b c", "s") for i in range(9)], "doc_id long, text string, source string")
    assert [r.taken for r in mixing.mix(docs).collect()] == [3] * 9


def test_targets_stop_at_three_times_the_source(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 1000), ("c", 5), (None, 0)], "source string, source_size long")
    got = {r.source: r.target for r in mixing.source_targets(sizes).collect()}
    assert got == pytest.approx(brute_targets({"a": 10, "b": 1000, "c": 5, None: 0}))
