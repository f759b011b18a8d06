from gradmill.llm import line_dedup

SCHEMA = "doc_id long, text string, source string, line string, removed int"


def run(spark, rows, **kw):
    docs = spark.createDataFrame([(i, t, s, "x", 9) for i, t, s in rows], SCHEMA)
    out = line_dedup.clean(docs, **kw)
    assert out.columns == docs.columns
    return sorted((str(r.doc_id), str(r.text)) for r in out.collect())


def slow(rows, min_sites):
    sites, first = {}, {}
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    for i, t, s in order:
        for k, part in enumerate(t.split("\n") if t is not None else []):
            line = part.strip(" \t\r")
            if line:
                first.setdefault(line, (i, k))
                if s is not None:
                    sites.setdefault(line, set()).add(s)
    out = []
    for i, t, s in rows:
        if t is not None:
            t = "\n".join(
                p for k, p in enumerate(t.split("\n"))
                if len(sites.get(p.strip(" \t\r"), ())) < min_sites or first[p.strip(" \t\r")] == (i, k)
            )
        out.append((str(i), str(t)))
    return sorted(out)


def test_spread_lines_keep_one_copy(spark):
    rows = [(i, f"own {i}\n  menu\t\nsite {i % 3}\n\nmenu", f"s{i % 7}") for i in range(30)]
    rows += [(100 + i, "menu", "s1") for i in range(40)] + [(200, None, "s2"), (201, "", "s3"), (202, "a\nb", None)]
    for least in (1, 2, 3, 4, 7, 8):
        assert run(spark, rows, min_sites=least) == slow(rows, least)


def test_sites_of_all_sizes(spark):
    """Lines on 1 to 60 sites: sketches decide the ends, counts the middle."""
    rows = [(k * 100 + s, f"line {k}", f"site {s}") for k in range(1, 61) for s in range(k)]
    assert run(spark, rows, min_sites=20) == slow(rows, 20)


def test_edge_cases(spark):
    assert run(spark, []) == []
    rows = [(None, "dup", f"s{i}") for i in range(3)] + [(4, "dup", "s9"), (4, "dup", "s9")]
    # the kept copy is in document 4; its repeated row is the same document
    assert run(spark, rows, min_sites=2) == sorted([("None", "")] * 3 + [("4", "dup")] * 2)
    only_null_sites = [(i, "same", None) for i in range(5)]
    assert run(spark, only_null_sites, min_sites=1) == slow(only_null_sites, 1)


def test_long_text(spark):
    text = "\n".join(f"line {i % 5000}" for i in range(60_000))
    rows = [(1, text, "a"), (2, text + "\nmore", "b")]
    got = dict(run(spark, rows, min_sites=2))
    assert got["1"] == "\n".join(f"line {i}" for i in range(5000)) and got["2"] == "more"
