from collections import defaultdict

from flightloom.llm.line_dedup import dedup_lines

from edge_rows import EDGE  # noqa: I001


def expected(rows, ratio, least):
    pages, on = defaultdict(set), defaultdict(set)
    for _, t, s in rows:
        pages[s].add(t or "")
        for line in (t or "").split("\n"):
            if line.replace("\t", " ").replace("\r", " ").strip(" "):
                on[s, line.replace("\t", " ").replace("\r", " ").strip(" ")].add(t or "")
    bad = {k for k, v in on.items() if len(v) >= least and len(v) > ratio * len(pages[k[0]])}
    out = []
    for d, t, s in rows:
        if t is None:
            out.append((d, None, 0))
            continue
        lines = t.split("\n")
        kept = [x for x in lines if (s, x.replace("\t", " ").replace("\r", " ").strip(" ")) not in bad]
        out.append((d, "\n".join(kept), len(lines) - len(kept)))
    return sorted(out, key=repr)


def found(df):
    return sorted(((r.doc_id, r.text, r.lines_dropped) for r in df.collect()), key=repr)


def test_relative_to_the_site(make_docs):
    rows = [(i, f"own {i}\n menu \r\n\nfooter of {i % 3}", "a" if i % 3 else None) for i in range(60)]
    rows += [(100 + i, f"menu\nother {i}" if i == 0 else f"other {i}", "b") for i in range(40)]
    df = dedup_lines(make_docs(rows), ratio=0.1, least_pages=3)
    assert found(df) == expected(rows, 0.1, 3)
    assert {r.lines_dropped for r in df.filter("source = 'b'").collect()} == {0}
    assert df.columns[:-1] == make_docs(rows).columns


def test_copies_count_once(make_docs):
    """A page that is copied a hundred times keeps its lines."""
    rows = [(i, "one line\nanother line", "a") for i in range(100)] + [(200 + i, f"page {i}", "a") for i in range(20)]
    assert all(r.lines_dropped == 0 for r in dedup_lines(make_docs(rows), least_pages=2).collect())


def test_edge_rows(edge):
    assert found(dedup_lines(edge, ratio=0.3, least_pages=1)) == expected(EDGE, 0.3, 1)


def test_pages_by_host(spark, sf_dir):
    """Any column can be the site, here the host of a page."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").selectExpr(
        "page_id AS doc_id", "replace(html, '><', '>\n<') AS text", "parse_url(url, 'HOST') AS host"
    )
    rows = [(r.doc_id, r.text, r.host) for r in pages.collect()]
    assert found(dedup_lines(pages, host="host", least_pages=2)) == expected(rows, 0.05, 2)


def test_no_broadcast_beyond_the_bound(make_docs, monkeypatch):
    from flightloom.llm import line_dedup

    rows = [(i, f"own {i}\nmenu", "a") for i in range(30)]
    monkeypatch.setattr(line_dedup, "BROADCAST_LINES", 0)
    assert found(dedup_lines(make_docs(rows))) == expected(rows, 0.05, 5)


def test_empty_table(nothing):
    assert dedup_lines(nothing).count() == 0
