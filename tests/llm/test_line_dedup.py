import duckdb
import pytest

from canvass.llm.line_dedup import ORACLE, digest, line_dedup


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(3)


def page(i, *lines, host="a.example"):
    return (i, f"https://u:p@{host}:8080/x?{i}", "".join(f"<p>{x}</p>" for x in lines))


def test_boilerplate_per_site(spark):
    rows = [page(i, "Menu", f"text {i}", "Rare" if i < 3 else f"own {i}") for i in range(10)]
    rows += [page(100 + i, "Menu", f"other {i}", host="b.example") for i in range(2)]
    got = {r.page_id: r for r in line_dedup(pages(spark, rows)).collect()}
    assert got[0].kept == ["text 0", "Rare"] and got[0].host == "a.example"  # on 3 of 10 pages: not above the ratio
    assert got[100].kept == ["Menu", "other 0"]  # too few pages to tell
    assert [got[5].n_lines, got[5].n_removed] == [3, 1]


def test_repeats_on_one_page_count_once(spark):
    rows = [page(i, *(["Again"] * 5 if i == 0 else [f"t{i}"])) for i in range(10)]
    assert {r.n_removed for r in line_dedup(pages(spark, rows)).collect()} == {0}


def test_large_sites_are_spread(spark):
    """However many keys a site's pages go to, the result is the same; small sites keep one."""
    rows = [page(i, "Menu", f"text {i}", "Rare" if i < 3 else f"own {i}") for i in range(30)] + [page(100 + i, f"x{i}", host="b.example") for i in range(2)]
    want = sorted(tuple(r) for r in digest(line_dedup(pages(spark, rows))).collect())
    for together in (1, 4, 29):
        assert sorted(tuple(r) for r in digest(line_dedup(pages(spark, rows), together=together)).collect()) == want


def test_extraction(spark):
    html = "<HEAD><title>T</title><script>var a='<p>no</p>'</script><style>p{}</style></head><!-- <p>no</p> --><p>one <b>two</b><br>three\r\n four <div></div>"
    (row,) = line_dedup(pages(spark, [(1, "HTTP://A.B/c", html)])).collect()
    assert row.kept == ["T", "one two", "three", "four"] and row.host == "a.b"


def test_shapes(spark):
    rows = [(1, None, "<p>x"), (None, "no host", None), (2, "", ""), (2, "", ""), (3, "http://h/", "<p>" + "long " * 200000)]
    got = sorted((r.page_id or 0, r.host, r.n_lines, r.n_removed) for r in line_dedup(pages(spark, rows)).collect())
    assert got == [(0, "", 0, 0), (1, "", 1, 0), (2, "", 0, 0), (2, "", 0, 0), (3, "h", 1, 0)]
    assert line_dedup(pages(spark, rows).filter("false")).collect() == []


def test_repeated_rows_and_clashing_columns(spark):
    rows = [page(1, "Menu", "a")] * 4
    df = pages(spark, rows).selectExpr("*", "url as site", "html as lines", "1 as salt")
    assert [r.n_removed for r in line_dedup(df).collect()] == [2] * 4


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_given_pages(spark, folder):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{folder}/pages.parquet'")
    got = sorted(tuple(r) for r in digest(line_dedup(spark.read.parquet(f"{folder}/pages.parquet"))).collect())
    assert got == sorted(con.execute(ORACLE).fetchall())
    assert sum(r[3] for r in got) > 0 or folder.endswith("0.001")
