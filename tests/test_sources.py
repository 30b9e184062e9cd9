"""Raw files, tables, pages and selector configurations."""

import json
import os
import shutil
import uuid

import pytest
from pyspark.sql import functions as F

from jobmart.operators import silver
from jobmart.sources import crawl, html, pages, raw_jobs, tables


def partition(tmp_path, content, load_date="2026-05-21"):
    folder = tmp_path / f"load_date={load_date}"
    folder.mkdir(parents=True)
    (folder / "jobs.jsonl").write_text(content, encoding="utf-8")
    return str(tmp_path)


# -- raw files --------------------------------------------------------------------


# Fixed values in the next two tests: inputs and results that were given.


def test_empty_file_gives_empty_tables(spark, tmp_path):
    raw = raw_jobs.read_raw_jobs(spark, partition(tmp_path, ""), "2026-05-21")
    assert silver.clean_jobs(raw).count() == 0
    assert silver.clean_companies(raw).count() == 0


def test_missing_title_is_unknown(spark, tmp_path):
    line = json.dumps({"company": "Acme", "company_location": "Hanoi", "source_name": "test"})
    raw = raw_jobs.read_raw_jobs(spark, partition(tmp_path, line + "\n"), "2026-05-21")
    assert [r.title for r in silver.clean_jobs(raw).collect()] == ["Unknown"]
    assert [r.name for r in silver.clean_companies(raw).collect()] == ["Acme"]


def test_bad_lines_become_rows_of_nulls(spark, tmp_path):
    lines = ['{"title": "good"}', "{bad", '{"title": {"a": 1}}', "", "[1,2]", '{"title": null, "extra": 1}',
             '{"title": true}', '"text"']
    raw = raw_jobs.read_raw_jobs(spark, partition(tmp_path, "\n".join(lines)), "2026-05-21")
    titles = [r.title for r in raw.collect()]
    assert len(titles) == 7 and titles.count(None) == 4
    assert {t for t in titles if t} == {"good", '{"a": 1}', "true"}


def test_values_of_any_written_form_have_one_form(spark, tmp_path):
    numbers = {
        "1.50": "1.5", "-2.500e2": "-250.0", "1e3": "1000.0", "15000000.5": "15000000.5", "1e15": "1000000000000000.0",
        "1e16": "1e+16", "0.0001": "0.0001", "0.00001": "1e-05", "-0.0": "-0.0", "0e0": "0.0", "7": "7", "1E-20": "1e-20",
        "100000000000000000000": "100000000000000000000", '"1.50"': "1.50", '"1.5E7"': "1.5E7", '"[ 1 ]"': "[ 1 ]",
        "[ 1, 2.50 ]": "[1,2.5]", "true": "true", "null": None, '""': "",
    }
    lines = [f'{{"title":"{k}", "salary": {n}}}' for k, n in enumerate(numbers)]
    raw = raw_jobs.read_raw_jobs(spark, partition(tmp_path, "\n".join(lines)), "2026-05-21", one_form=True)
    found = {int(r["title"]): r["salary"] for r in raw.collect()}
    assert [found[k] for k in range(len(lines))] == list(numbers.values())


def test_the_first_of_repeated_keys_counts_and_broken_lines_are_empty(spark, tmp_path):
    lines = [
        '{"title":"a","title":"b","salary":1.50,"salary":"x"}', '{"title":null,"title":"b"}', '{"title":{"x":1,"x":2},"title":3}',
        '{"title":"ok"', '[{"title":"a"},{"title":"b"}]', '"text"', "5", "nul", "[]", "{}", " ", "\t", "",
    ]
    raw = raw_jobs.read_raw_jobs(spark, partition(tmp_path, "\n".join(lines)), "2026-05-21", with_order=True, one_form=True)
    rows = [tuple(r) for r in raw.orderBy(*raw_jobs.FILE_ORDER).select("title", "salary").collect()]
    assert rows == [("a", "1.5"), (None, None), ('{"x":1,"x":2}', None), *[(None, None)] * 7]


def test_a_line_is_parsed_once_for_all_fields(spark, tmp_path):
    raw = raw_jobs.read_raw_jobs(spark, partition(tmp_path, "{}"), "2026-05-21", one_form=True)
    plan = raw._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json(StructField") == 1 and plan.count("jsonObjectKeys") == 1


def test_write_keeps_nulls_and_replaces_only_its_date(spark, tmp_path):
    raw = spark.createDataFrame([("a", None), ("b", "x")], "title string, company string")
    raw = raw.withColumns({c: F.lit(None).cast("string") for c in raw_jobs.RAW_COLUMNS if c not in raw.columns})
    base = str(tmp_path / "out")
    raw_jobs.write_raw_jobs(raw, base, "2026-05-20")
    for _ in range(2):
        raw_jobs.write_raw_jobs(raw.limit(1), base, "2026-05-21")
    assert raw_jobs.read_raw_jobs(spark, base, "2026-05-20").count() == 2
    assert raw_jobs.read_raw_jobs(spark, base, "2026-05-21").count() == 1
    line = spark.read.text(raw_jobs.partition_path(base, "2026-05-21")).first()[0]
    assert json.loads(line) == {c: ("a" if c == "title" else None) for c in raw_jobs.RAW_COLUMNS}


def test_publish(spark, tmp_path, monkeypatch):
    staged = partition(tmp_path / "staged", '{"title": "a"}\n{"title": "b"}\n')
    target = str(tmp_path / "target")
    for _ in range(2):  # a retry does not duplicate
        assert raw_jobs.publish_partition(spark, staged, target, "2026-05-21") == 2
    assert raw_jobs.read_raw_jobs(spark, target, "2026-05-21").count() == 2
    # A job that fails on its way leaves the published day readable.
    day = tmp_path / "staged" / "load_date=2026-05-21"
    (day / "bad.json.gz").write_bytes(b"not compressed at all")
    with pytest.raises(Exception):  # noqa: B017
        raw_jobs.publish_partition(spark, staged, target, "2026-05-21")
    assert raw_jobs.read_raw_jobs(spark, target, "2026-05-21").count() == 2
    (day / "bad.json.gz").unlink()
    # A failure after the new day was complete, the old one being gone already: the next reader finishes.
    (day / "more.json").write_text('{"title": "c"}\n')
    with monkeypatch.context() as patch:
        patch.setattr(raw_jobs, "finish_publishing", lambda *_: False)
        with pytest.raises(OSError):
            raw_jobs.publish_partition(spark, staged, target, "2026-05-21")
    shutil.rmtree(tmp_path / "target" / "load_date=2026-05-21")
    assert raw_jobs.read_raw_jobs(spark, target, "2026-05-21").count() == 3
    (day / "more.json").unlink()
    assert raw_jobs.publish_partition(spark, staged, target, "2026-05-21") == 2
    with pytest.raises(ValueError, match="nothing staged"):
        raw_jobs.publish_partition(spark, staged, target, "2026-05-22")
    assert raw_jobs.clear_staged(spark, staged) and not raw_jobs.clear_staged(spark, staged)
    with pytest.raises(ValueError, match="nothing staged"):  # cleared is not empty: what was published stays
        raw_jobs.publish_partition(spark, staged, target, "2026-05-21")
    assert raw_jobs.read_raw_jobs(spark, target, "2026-05-21").count() == 2


def test_file_order_keeps_the_first_line(spark, tmp_path):
    lines = [json.dumps({"title": f"t{i}", "job_url": f"u{i % 3}"}) for i in range(9)]
    raw = raw_jobs.read_raw_jobs(spark, partition(tmp_path, "\n".join(lines)), "2026-05-21", with_order=True)
    jobs = silver.silver_jobs(raw, raw_jobs.FILE_ORDER)
    assert sorted(r.title for r in jobs.collect()) == ["t0", "t1", "t2"]


# -- tables -----------------------------------------------------------------------


@pytest.fixture(params=["dynamic", "static"])
def prefix(spark, tmp_path, request):
    """Namespaces of its own; tests of tables run under both modes of overwriting that a session may have."""
    mode = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode)
    spark.conf.set(mode, request.param)
    name = f"t{uuid.uuid4().hex[:8]}_"
    tables.ensure_namespaces(spark, str(tmp_path / "warehouse"), name)
    yield name
    spark.conf.set(mode, before)


def numbers(spark, *values):
    return spark.createDataFrame([(v, v * 10) for v in values], "id int, v int")


def ids(spark, name):
    return sorted(r.id for r in spark.table(name).collect())


def test_read_and_overwrite(spark, prefix):
    name = prefix + "silver.jobs"
    with pytest.raises(ValueError, match="does not exist"):
        tables.read_table(spark, name)
    assert tables.overwrite_table(numbers(spark, 1, 2), name) == 2
    with pytest.raises(ValueError, match="empty"):
        tables.overwrite_table(numbers(spark, 1).limit(0), name)
    assert ids(spark, name) == [1, 2]
    assert tables.overwrite_table(spark.table(name).where("id = 2"), name) == 1
    assert ids(spark, name) == [2]
    assert tables.overwrite_table(numbers(spark, 1).limit(0), name, allow_empty=True) == 0
    with pytest.raises(ValueError, match="no rows"):
        tables.read_table(spark, name)
    assert tables.read_table(spark, name, allow_empty=True).columns == ["id", "v"]


def test_only_staging_may_change_its_schema(spark, prefix):
    other = spark.createDataFrame([("x",)], "name string")
    for layer, allowed in (("staging", True), ("silver", False)):
        name = f"{prefix}{layer}.t"
        tables.overwrite_table(numbers(spark, 1), name)
        if allowed:
            assert tables.overwrite_table(other, name) == 1
        else:
            with pytest.raises(ValueError, match="schema"):
                tables.overwrite_table(other, name)


def test_append_and_upsert(spark, prefix):
    name = prefix + "gold.t"
    assert tables.append_table(numbers(spark, 1, 2), name) == 2
    assert tables.append_table(numbers(spark, 2).select("v", "id"), name) == 1
    assert ids(spark, name) == [1, 2, 2]
    name = prefix + "gold.u"
    assert tables.upsert_table(numbers(spark, 1, 2), name, "id") == 2
    changed = numbers(spark, 2, 3).withColumn("v", F.lit(0))
    for _ in range(2):
        assert tables.upsert_table(changed, name, "id") == 2
        assert sorted((r.id, r.v) for r in spark.table(name).collect()) == [(1, 10), (2, 0), (3, 0)]
    assert tables.upsert_table(changed.limit(0), name, "id") == 0
    with pytest.raises(ValueError, match="more than once"):
        tables.upsert_table(numbers(spark, 5, 5), name, "id")
    with pytest.raises(ValueError, match="not in the input"):
        tables.upsert_table(changed, name, "gone")


def test_partitioned_tables_stay_partitioned(spark, prefix, tmp_path):
    name = prefix + "gold.p"
    rows = spark.createDataFrame([("20260521", 1), ("20260522", 2)], "day string, id int")
    assert tables.append_table(rows, name, partition_by="day") == 2
    assert tables.append_table(rows.withColumn("id", F.col("id") + 10), name, partition_by="day") == 2
    assert tables.upsert_table(rows.withColumn("day", F.lit("20260523")), name, "id") == 2
    assert sorted((r.id, r.day) for r in spark.table(name).collect()) == [
        (1, "20260523"), (2, "20260523"), (11, "20260521"), (12, "20260522"),
    ]
    assert [c.name for c in spark.catalog.listColumns(name) if c.isPartition] == ["day"]


def test_a_replacement_survives_a_crash_at_every_step(spark, prefix, monkeypatch):
    """Whatever step fails, a retry keeps every row, partitioned or not."""
    class Crash(Exception):
        pass

    session = type(spark)
    real_sql = session.sql
    for partition_by in (None, "day"):
        for step in range(6):
            name = f"{prefix}gold.r{partition_by or 'n'}{step}"
            rows = spark.range(100).select(F.col("id").cast("int").alias("id"), F.lit("a").alias("day"))
            tables.append_table(rows, name, partition_by=partition_by)
            calls = {"n": 0}

            def failing(self, query, *args, **options):
                if query.startswith(("DROP", "ALTER")):
                    calls["n"] += 1
                    if calls["n"] == step + 1:  # noqa: B023
                        raise Crash
                return real_sql(self, query, *args, **options)

            more = spark.createDataFrame([(500, "b")], "id int, day string")
            monkeypatch.setattr(session, "sql", failing)
            try:
                tables.upsert_table(more, name, "id")
            except Crash:
                pass
            monkeypatch.setattr(session, "sql", real_sql)
            tables.upsert_table(more, name, "id")
            assert sorted(r.id for r in tables.read_table(spark, name).collect()) == [*range(100), 500], (partition_by, step)
            assert not [t for t in spark.catalog.listTables(prefix + "gold") if "__" in t.name and t.name.startswith(name)]


def test_format_partitions_and_properties_survive(spark, prefix):
    name = prefix + "gold.f"
    spark.sql(f"CREATE TABLE {name} (id INT, v INT) USING orc TBLPROPERTIES ('owner_team' = 'x''y')".replace("''", ""))
    tables.upsert_table(numbers(spark, 1, 2), name, "id")
    tables.overwrite_table(numbers(spark, 3), name)
    assert ids(spark, name) == [3] and tables._provider(spark, name) == "orc"
    assert tables._properties(spark, name)["owner_team"] == "xy"


def test_upsert_by_buckets_leaves_other_partitions_alone(spark, prefix):
    name = prefix + "gold.b"
    assert tables.upsert_table(numbers(spark, *range(200)), name, "id", buckets=16) == 200
    files = lambda: {r.f for r in spark.table(name).select(F.input_file_name().alias("f")).distinct().collect()}
    before = files()
    changed = numbers(spark, 7, 1_000).withColumn("v", F.lit(-1))
    for _ in range(2):  # a retry changes nothing
        assert tables.upsert_table(changed, name, "id") == 2
        rows = {r.id: r.v for r in spark.table(name).collect()}
        assert rows == {i: i * 10 for i in range(200)} | {7: -1, 1_000: -1}
    assert len(before & files()) >= 14
    with pytest.raises(ValueError, match="more than once"):
        tables.upsert_table(numbers(spark, 5, 5), name, "id")


def test_a_replaced_table_has_no_old_partitions(spark, prefix):
    rows = spark.range(100).select(F.col("id").cast("int").alias("id"), F.concat(F.lit("d"), F.col("id") % 4).alias("day"))
    for layer in ("gold", "staging"):
        name = f"{prefix}{layer}.parts"
        tables.append_table(rows, name, partition_by="day")
        assert tables.overwrite_table(spark.table(name).where("day = 'd1'"), name) == 25
        assert spark.table(name).count() == 25 and [r[0] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()] == ["day=d1"]
        assert tables.append_table(rows, name) == 100 and spark.table(name).count() == 125
        tables.clear_tables(spark, [name])
        assert spark.table(name).count() == 0 and tables._partition_columns(spark, name) == ["day"]


def test_an_upsert_survives_a_crash_at_every_step(spark, prefix, monkeypatch):
    """Whatever call of the catalog fails, stored rows are old or new, and a retry makes all of them new."""
    session = type(spark)
    real_sql = session.sql
    for step in (0, 1, 3):
        name = f"{prefix}gold.c{step}"
        tables.upsert_table(numbers(spark, *range(100)), name, "id", buckets=4)
        changed = numbers(spark, 1, 2, 3, 4, 5, 6, 7, 500).withColumn("v", F.lit(-1))
        calls = {"n": 0}

        def failing(self, query, *args, **options):
            if query.startswith("ALTER"):
                calls["n"] += 1
                if calls["n"] == step + 1:  # noqa: B023
                    raise RuntimeError("crash")
            return real_sql(self, query, *args, **options)

        monkeypatch.setattr(session, "sql", failing)
        try:
            tables.upsert_table(changed, name, "id")
        except RuntimeError:
            pass
        monkeypatch.setattr(session, "sql", real_sql)
        spark.catalog.refreshTable(name)
        rows = {r.id: r.v for r in spark.table(name).collect()}
        assert set(rows) - {500} == set(range(100)) and all(v in (i * 10, -1) for i, v in rows.items()), step
        assert tables.upsert_table(changed, name, "id") == 8
        rows = {r.id: r.v for r in spark.table(name).collect()}
        assert rows == {i: i * 10 for i in range(100)} | dict.fromkeys([1, 2, 3, 4, 5, 6, 7, 500], -1)


def test_rows_of_a_key_are_replaced_together(spark, prefix):
    name = prefix + "gold.k"
    rows = spark.createDataFrame([(i % 10, i) for i in range(40)], "id int, v int")
    for buckets in (8, None):
        tables.drop_table(spark, name)
        assert tables.replace_by_key(rows, rows.select("id"), name, "id", buckets) == 40
        fewer = spark.createDataFrame([(1, -1), (2, -2), (2, -3)], "id int, v int")
        gone = spark.createDataFrame([(1,), (2,), (3,), (77,)], "id int")
        for _ in range(2):
            assert tables.replace_by_key(fewer, gone, name, "id", buckets) == 3
            found = sorted((r.id, r.v) for r in spark.table(name).collect())
            assert found == sorted([(1, -1), (2, -2), (2, -3), *[(i % 10, i) for i in range(40) if i % 10 not in (1, 2, 3)]])


def test_runs_are_appended_once_each(spark, prefix):
    name = prefix + "gold.runs"
    for run, values in (("2026-05-21", (1, 2)), ("2026-05-22", (2, 3)), ("2026-05-21", (1, 9)), ("2026-05-21", (1, 9))):
        assert tables.append_table(numbers(spark, *values), name, run=run) == 2
    assert ids(spark, name) == [1, 2, 3, 9] and tables.read_table(spark, name).columns == ["id", "v"]
    assert tables.append_table(numbers(spark, 1).limit(0), name, run="2026-05-22") == 0
    assert ids(spark, name) == [1, 9]
    tables.append_table(numbers(spark, 1), prefix + "gold.plain")
    with pytest.raises(ValueError, match="run"):
        tables.append_table(numbers(spark, 1), prefix + "gold.plain", run="x")


def test_dropping_leaves_foreign_files(spark, prefix, tmp_path):
    path = str(tmp_path / "foreign")
    numbers(spark, 1, 2).write.parquet(path)
    spark.sql(f"CREATE TABLE {prefix}gold.foreign USING parquet LOCATION '{path}'")
    tables.drop_table(spark, prefix + "gold.foreign")
    assert spark.read.parquet(path).count() == 2
    tables.overwrite_table(numbers(spark, 1), prefix + "gold.own")
    folder = tables._described(spark, prefix + "gold.own")["Location"].removeprefix("file:")
    assert os.path.exists(folder)
    tables.drop_table(spark, prefix + "gold.own")
    assert not os.path.exists(folder)


def test_catalog_and_clear(spark, prefix):
    name = prefix + "staging.t"
    tables.get_or_create_table(numbers(spark, 1), name)
    assert ids(spark, name) == [] and tables.table_exists(spark, name)
    tables.overwrite_table(numbers(spark, 1), name)
    assert tables.clear_tables(spark, [name, prefix + "staging.none"]) == {name: 0, prefix + "staging.none": 0}
    assert ids(spark, name) == [] and spark.table(name).columns == ["id", "v"]
    assert [r.table_name for r in tables.list_tables(spark, prefix + "staging").collect()] == ["t"]
    assert tables.drop_table(spark, name) and not tables.drop_table(spark, name)


# -- html -------------------------------------------------------------------------


def test_selectors():
    root = html.parse(
        '<div class="job x" id="a"><p>One <b>two</b><p>three<script>var t="</p>";</script></div>'
        '<div class="job"><a href="/jobs/1?q=a&amp;b">L</a><img alt="i"></div></div>'
    )

    def tags(selector):
        return [n.tag + ":" + n.text() for n in html.Selector(selector).select(root)]

    assert tags(".job.x") == ["div:One two three"]
    assert tags("#a b") == ["b:two"]
    assert tags("div > b") == [] and tags("div > p > b") == ["b:two"]
    assert tags("a[href^='/jobs']") == tags('[href*="1?"]') == tags("a[href$=b]") == ["a:L"]
    assert tags("img[alt]") == ["img:"] and tags("[alt=x]") == []
    assert tags("b, a") == ["b:two", "a:L"] and len(tags("*")) == 8
    for bad in ("div:has(> p)", "a + b", "", "div >", "a ~ b", 'p:-soup-contains("x")'):
        with pytest.raises(ValueError):
            html.Selector(bad)


def test_extract_value():
    root = html.parse('<li class="i" data-x=" 7 "><a href="/x">T <i>u</i></a><span></span></li>')
    cases = {
        "a@text()": "T u", "a": "T u", "a@href": "/x", "a@title": None, "@text()": "T u", "@data-x": None,
        "data-x": None, "li@data-x": " 7 ", "span": None, "gone": None, "": None, None: None, "[href]": "T u",
    }
    assert {spec: html.extract_value(root, spec) for spec in cases} == cases


def test_markup_is_written_back():
    markup = '<li class="a"><a href="/x?a&amp;b">1 &lt; 2 &amp; "3"</a><br/><script>if (a < b) {}</script></li>'
    assert next(html.Selector("li").select(html.parse(markup))).source() == markup


def test_items_and_fields(spark):
    page_rows = [
        (1, "s", "http://h/a", '<ul class="l"><li><a href="/1">A</a></li><li><b>B</b></li></ul>'),
        (2, "s", "http://h/b", None), (3, "s", "http://h/c", ""), (4, "other", "http://h/d", "<li>x</li>"),
        (5, "nosel", "http://h/e", "<li>x</li>"), (6, "s", "http://h/f", "<p>none</p>"),
    ]
    page_table = spark.createDataFrame(page_rows, "page_id int, source_name string, url string, html string")
    sources = spark.createDataFrame([("s", ".l > li"), ("nosel", None)], "source_name string, entry_point string")
    items = pages.explode_listing_items(page_table, sources)
    assert sorted((r.page_id, r.item_no, r.item_html) for r in items.collect()) == [
        (1, 0, '<li><a href="/1">A</a></li>'), (1, 1, "<li><b>B</b></li>"),
    ]
    configs = spark.createDataFrame([("s", "a@text()", "a@href")], "source_name string, title string, job_url string")
    configs = configs.withColumns(
        {f: F.lit(None).cast("string") for f in pages.LISTING_FIELDS if f not in ("title", "job_url")}
    )
    fields = pages.extract_fields(items, configs).orderBy("item_no").collect()
    assert [(r.title, r.job_url, r.salary) for r in fields] == [("A", "/1", None), (None, None, None)]


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_pages_are_not_shuffled_by_source(spark, tmp_path):
    """A stored table of sources is broadcast by its size, without a hint; a large one is joined by a splittable join."""
    page_table = spark.range(1000).select(
        F.col("id").alias("page_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise("cold").alias("source_name"),
        F.lit("http://h/").alias("url"), F.lit("<p>x</p>").alias("html"),
    )
    page_table.select("source_name").distinct().withColumn("entry_point", F.lit("p")).write.parquet(str(tmp_path / "s"))
    sources = spark.read.parquet(str(tmp_path / "s"))
    items = pages.explode_listing_items(page_table, sources)
    plan = physical(items)
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
    assert items.count() == 1000
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        # Both sides are exchanged for this join alone, which is what skew splitting asks for.
        plan = physical(pages.explode_listing_items(page_table, sources))
        assert "SortMergeJoin" in plan and plan.count("ENSURE_REQUIREMENTS") == 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


BAD = ["div:has(p)", "a >", "> a", "p:-soup-contains('x')", "a,,b", "a + b", "[x"]
GOOD = ["p", "*", ".a.b", "#i", "a[href^='/x,y']", "ul > li a", "div.job , p", "[data-id]", "a[ x = \"1\" ]", ""]


def test_supported_selectors_are_those_that_compile(spark):
    df = spark.createDataFrame([(s,) for s in [*BAD, *GOOD, None]], "s string")
    found = {r.s: r.ok for r in df.select("s", pages.is_supported(F.col("s")).alias("ok")).collect()}
    assert found == dict.fromkeys(BAD, False) | dict.fromkeys([*GOOD, None], True)
    for selector in filter(None, GOOD):
        html.Selector(selector)
    for selector in BAD:
        with pytest.raises(ValueError, match="selector"):
            html.Selector(selector)


def test_one_bad_selector_stops_no_other_source(spark):
    page_table = spark.createDataFrame(
        [(i, s, "u", "<p>x</p>") for i, s in enumerate("abc")], "page_id int, source_name string, url string, html string"
    )
    sources = spark.createDataFrame(
        [("a", "p", None), ("b", "div:has(p)", None), ("c", "p", "h1"), ("d", None, None)],
        "source_name string, entry_point string, detail_entry_point string",
    )
    found = pages.explode_listing_items(page_table, sources).collect()
    assert sorted(r.source_name for r in found) == ["a", "c"]
    configs = [config(source_name=s, title="p", prefix_job_url="http://h", job_url="a@href") for s in "abd"]
    configs[0]["salary"] = "b:not(i)@text()"
    table = spark.createDataFrame([tuple(c.values()) for c in configs], crawl.CONFIG_SCHEMA)
    problems = {(r.source_name, r.field, r.problem) for r in pages.config_problems(sources, table).collect()}
    assert problems == {
        ("a", "salary", "unsupported"), ("b", "entry_point", "unsupported"), ("c", None, "missing"),
        ("d", "entry_point", "missing"),
    }


def test_pages_to_postings(spark):
    listing = '<ul><li><a href="../job/1">One</a><b>1,000 usd</b></li><li><a href="/job/2">Two</a></li><li>none</li></ul>'
    listings = spark.createDataFrame(
        [(1, "s", "http://h/list", listing), (2, "incomplete", "http://h/list", listing)],
        "page_id int, source_name string, url string, html string",
    )
    details = spark.createDataFrame(
        [("s", "http://h/job/1", "<h1>t</h1><div class=d>Long <i>text</i></div>"), ("s", "http://h/job/9", "<p>unasked")],
        "source_name string, url string, html string",
    )
    sources = spark.createDataFrame(
        [("s", "ul > li", ".d"), ("incomplete", "li", None)], "source_name string, entry_point string, detail_entry_point string"
    )
    configs = [
        config(source_name="s", title="a", job_url="a@href", prefix_job_url="http://h/jobs/x", salary="b@text()"),
        config(source_name="incomplete", title="a", job_url="a@href", prefix_job_url=""),
    ]
    table = spark.createDataFrame([tuple(c.values()) for c in configs], crawl.CONFIG_SCHEMA)
    found = pages.extract_postings(listings, details, sources, table).orderBy("item_no").collect()
    assert [(r.title, r.job_url, r.salary, r.description) for r in found] == [
        ("One", "http://h/job/1", "1,000 usd", "Long text"), ("Two", "http://h/job/2", None, None), (None, None, None, None),
    ]
    assert set(raw_jobs.RAW_COLUMNS) <= set(found[0].asDict())


def test_urls(spark):
    from urllib.parse import urljoin

    prefixes = ["https://h.example/a/b?q=1#f", "https://h.example", "http://h.example/a/", "", None]
    links = ["../x/1", "./y", "..", "../../../z?q=../w", "/a/./b/../c", "a//b/.", ".", "x/..", "/x", "x/y", "/a//b", "/a//../b", "/a//", "//a/b/../c", " /lead", "\t x/y", "\x01..", "a//../b", "/.//x", "//c.example/z", "https://o.example/p", "?k=v", "#t", "mailto:a@b", "", None]
    df = spark.createDataFrame([(p, u) for p in prefixes for u in links], "p string, u string")
    for r in df.select("p", "u", pages.resolve_urls(F.col("u"), F.col("p")).alias("got")).collect():
        wanted = None if not r.u else urljoin(r.p, r.u) if r.p else r.u
        assert r.got == wanted, (r.p, r.u)


def test_details(spark):
    details = spark.createDataFrame(
        [("s", "u1", "<h1>T</h1><div class=d>D <b>e</b></div>"), ("s", "u2", "<p>whole</p>"),
         ("raw", "u3", "<p>x</p>"), ("s", "u4", "")],
        "source_name string, url string, html string",
    )
    sources = spark.createDataFrame([("s", ".d"), ("raw", None)], "source_name string, detail_entry_point string")
    items = spark.createDataFrame(
        [("s", "u1"), ("s", "u2"), ("raw", "u3"), ("s", "u4"), ("s", "gone"), ("s", None), ("s", None)],
        "source_name string, job_url string",
    )
    got = sorted(
        ((r.job_url, r.description) for r in pages.join_details(items, details, sources).collect()), key=repr
    )
    assert got == sorted([
        ("u1", "D e"), ("u2", "whole"), ("u3", "<p>x</p>"), ("u4", None), ("gone", None), (None, None), (None, None),
    ], key=repr)


def test_detail_pages_stay_where_they_are_read(spark, tmp_path):
    """No shuffle carries markup, and pages that nobody asks for are not parsed."""
    details = spark.createDataFrame([("s", f"u{i}", f"<h1>T{i}</h1>") for i in range(300)], "source_name string, url string, html string")
    details.write.parquet(str(tmp_path / "details"))
    sources = spark.createDataFrame([("s", "h1")], "source_name string, detail_entry_point string")
    sources.write.parquet(str(tmp_path / "sources"))
    details, sources = (spark.read.parquet(str(tmp_path / n)) for n in ("details", "sources"))
    items = spark.createDataFrame([(i, "s", f"u{i}" if i % 3 else None) for i in range(0, 60)], "i int, source_name string, job_url string")
    joined = pages.join_details(items, details, sources)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("MapInPandas") :]
    assert "Exchange hashpartitioning" not in below and "Sort" not in below
    assert {r.i: r.description for r in joined.collect()} == {i: f"T{i}" if i % 3 else None for i in range(60)}
    passed = details.where(pages.asked_filter(items)(F.col("source_name"), F.col("url"))).select("url").collect()
    assert {f"u{i}" for i in range(60) if i % 3} <= {r.url for r in passed} and len(passed) < 50
    # A filter of few bits lets more pages pass, and the result is the same.
    few = details.where(pages.asked_filter(items, 1 << 15)(F.col("source_name"), F.col("url")))
    assert few.count() >= len(passed)


# -- crawl ------------------------------------------------------------------------


def test_frontier(spark):
    sources = spark.createDataFrame(
        [("a", "https://a/{role_slug}/{page}", None), ("b", "https://b?q={role_query}", 1), ("c", "https://c/{page}", 2)],
        "source_name string, url_template string, end_page int",
    )
    got = crawl.crawl_frontier(sources, ["backend", "it-support", "AI", "qa"]).collect()
    assert len(got) == 16
    assert {(r.role, r.url) for r in got if r.source_name == "b"} >= {("it support", "https://b?q=it+support")}
    assert {(r.page, r.url) for r in got if r.source_name == "c"} == {(1, "https://c/1"), (2, "https://c/2")}


def config(**fields):
    return {f: fields.get(f) for f in pages.CONFIG_FIELDS}


def test_missing_configs(spark):
    configs = [
        config(source_name="full", title="a", prefix_job_url="p", job_url="u", salary="s"),
        config(source_name="nulls", title="a", prefix_job_url="p", job_url="u"),
        config(source_name="notitle", title="", prefix_job_url="p", job_url="u"),
        config(source_name="noprefix", title="a", prefix_job_url="", job_url="u"),
    ]
    table = spark.createDataFrame([tuple(c.values()) for c in configs], crawl.CONFIG_SCHEMA)
    names = ["full", "nulls", "notitle", "noprefix", "absent"]
    sources = spark.createDataFrame([(n,) for n in names], "source_name string")

    def missing(table):
        return sorted(r.source_name for r in crawl.sources_missing_config(sources, table).collect())

    assert missing(table) == ["absent", "noprefix", "notitle"]
    assert missing(table.drop("salary")) == sorted(names)


def test_config_files(spark, tmp_path):
    one, two = config(source_name="b", title="t"), config(source_name="a", title=None)
    for i, document in enumerate([[one, two], {"source_configs": [one, two]}, {"source_configs": {"x": one, "y": two}}]):
        path = tmp_path / f"c{i}.json"
        path.write_text(json.dumps(document, indent=2))
        loaded = crawl.load_source_configs(spark, str(path))
        assert sorted((r.source_name, r.title or "") for r in loaded.collect()) == [("a", ""), ("b", "t")]
    crawl.write_source_configs(loaded, str(tmp_path / "out"))
    lines = [line for file in sorted((tmp_path / "out").glob("part-*")) for line in file.read_text().splitlines()]
    written = [json.loads(line)["source_configs"][0] for line in lines]
    assert [c["source_name"] for c in written] == ["a", "b"]
    assert set(written[0]) == set(pages.CONFIG_FIELDS)
    again = crawl.load_source_configs(spark, str(tmp_path / "out"), one_per_line=True)
    assert sorted(again.collect()) == sorted(loaded.collect())
    assert crawl.normalise_config(loaded.select("source_name")).first().prefix_job_url == ""


def test_a_line_is_parsed_a_few_times_whatever_its_fields_need(spark):
    """Each look-up is a parse: a field has two at most, and lines with repeated keys are parsed once for all fields."""
    lines = spark.createDataFrame([('{"title": 1e3, "title": 2, "salary": 15e-1}',)], "value string")
    fields = raw_jobs.json_fields(lines, raw_jobs.RAW_COLUMNS)
    plan = fields._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("get_json_object(") <= 2 * len(raw_jobs.RAW_COLUMNS)
    assert plan.count("from_json(") <= 2
    assert fields.select("title", "salary").first() == ("1000.0", "1.5")


def test_a_released_tree_needs_no_search_for_cycles():
    """Parsed pages are freed one by one, whatever the size of a batch."""
    import gc

    gc.collect()
    gc.disable()
    try:
        root = html.parse("<div><p>a<b>c</b></p></div>" * 50)
        root.release()
        del root
        assert not [o for o in gc.get_objects() if isinstance(o, html.Node)]
    finally:
        gc.enable()
