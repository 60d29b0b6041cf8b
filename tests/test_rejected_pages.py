"""Every page is accounted for: its records, or why it has none, from one parse."""

from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from panelkit.session import work_dir
from panelkit.sources import api_pages as A
from panelkit.sources import html as H
from panelkit.sources import outcomes as O

REC = StructType([StructField("n", StringType())])
BODIES = ['{"results": [{"n": "1"}, {"n": null}]}', '{"results": [{"n": ', '{"error": 1}', None, '{"results": []}', "", "<html>", "[]"]


def api(spark):
    pages = spark.createDataFrame(list(enumerate(BODIES)), "page int, body string")
    return A.parse_pages(pages, "body", REC, ("page",))


def test_api_pages(spark):
    parsed = api(spark)
    assert sorted((r.page, str(r.n)) for r in O.records(parsed).collect()) == [(0, "1"), (0, "None")]
    got = {r.page: r.reason for r in O.rejects(parsed, ["page"]).collect()}
    assert got == {1: "no JSON", 2: "no results array", 3: "no body", 5: got[5], 6: "no JSON", 7: got[7]}
    assert {got[5], got[7]} <= {"no JSON", "no results array"}
    assert [r.page for r in parsed.where(F.col("outcome") == O.EMPTY).collect()] == [4]
    plan = parsed._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1 and "parse_json" not in plan  # one parse


def test_landed_once_and_counted(spark):
    landed = O.land_parsed(api(spark), work_dir(spark, "t_landed"), A.first_of_page())
    assert (landed.n_pages, landed.n_records, landed.n_empty, landed.n_rejected) == (len(BODIES), 2, 1, 6)
    assert landed.records(spark).count() == 2 and landed.rejects(spark, ["page"]).count() == 6
    assert landed.n_pages == landed.records(spark).select("page").distinct().count() + landed.n_empty + landed.n_rejected


def test_page_files(spark):
    root = work_dir(spark, "t_rejected").removeprefix("file://").removeprefix("file:")
    for name, body in (("a", '{"results": [{"n": "1"}]}'), ("b", '{"results": ['), ("c", '{"x": 1}')):
        with open(f"{root}/{name}.json", "w") as fh:
            fh.write(body)
    df = spark.read.schema(A.page_schema(REC)).option("multiLine", True).json(root)
    parsed = A.parse_page_files(df)
    assert {r.file_path.rsplit("/", 1)[1]: r.reason for r in O.rejects(parsed, ["file_path"]).collect()} == {
        "b.json": "no JSON", "c.json": "no results array"}
    assert [r.n for r in A.flatten_page_files(df).collect()] == ["1"]


NESTED = ("<p></table></p><!-- <table><tr><td>no</td></tr></table> --><script>var t = '<table>';</script>"
          "<TABLE id=x><thead><tr><th>A<th>B</thead><tr><td>1</td><td>x<table><tr><th>in</th></tr><tr><td>ner <b>one</b></td>"
          "<td><table><tr><td>deep</td></tr></table></td></tr></table>y</td></tr><tr><td>2<td>after</tr>"
          "<tr><td>&lt;3&gt;</td></tr></table><table><tr><th>A</th></tr><tr><td>decoy</td></tr></table>")


def test_the_first_table_by_nesting_depth(spark):
    pages = spark.createDataFrame([("p", NESTED)], "k string, html string")
    rows = H.first_table_rows(pages, ["k"], columns=["A", "B"]).orderBy("row_no").collect()
    assert [(r.row_no, r.A, r.B and " ".join(r.B.split())) for r in rows] == [(1, "1", "x in ner one deep y"), (2, "2", "after"), (3, "<3>", None)]


def test_tables_and_rejects(spark):
    cases = {"none": None, "empty": "", "text": "<p>no</p>", "bare": "<table></table><table><tr><th>A<tr><td>1</table>",
             "head": "<table><tr><th>A</th></tr></table>", "open": "<table><tr><th>A</th></tr><tr><td>1", "end": "</table>",
             "good": "<table><tr><th>A</th></tr><tr><td>1</td></tr><tr></tr></table>"}
    parsed = H.parse_tables(spark.createDataFrame(list(cases.items()), "k string, html string"), ["k"])
    outcome = {r.k: r.outcome for r in parsed.collect()}
    assert outcome == {"none": "no page", "empty": "no table", "text": "no table", "bare": "no header", "head": "empty",
                       "open": "record", "end": "no table", "good": "record"}
    landed = O.land_parsed(parsed, work_dir(spark, "t_tables"), H.first_of_page())
    assert (landed.n_pages, landed.n_records, landed.n_empty, landed.n_rejected) == (8, 3, 1, 5)
    assert H.parse_tables(spark.createDataFrame([], "k string, html string"), ["k"]).count() == 0


def test_many_nested_tables(spark):
    inner = "<table><tr><td>i</td></tr></table>"
    page = "<table><tr><th>A</th></tr>" + f"<tr><td>{inner}</td></tr>" * 2000 + "</table>" + inner * 50
    rows = H.first_table_rows(spark.createDataFrame([("p", page)], "k string, html string"), ["k"], columns=["A"]).collect()
    assert len(rows) == 2000 and {r.A for r in rows} == {"i"}
