"""XML records however they are written, as the built-in reader finds them."""

import random

import pytest

from brokerdw.sources import scans

ROWS = """<?xml version="1.0"?>
<x:All xmlns:x="urn:x"><x:Row id="1"><a>one</a></x:Row>
<x:Row
  id="2"><a>two &amp; more</a>
</x:Row><x:Row id="3"/><x:Row id="4" note="a > b / c"/>
<!-- <x:Row id="99"><a>no record</a></x:Row> --><x:Row id="5"\t><a>five</a><b>x</b></x:Row>
<x:Rowing id="98"/><x:Row id='6'><!-- said --><a>six</a></x:Row><x:Row id="7" />
</x:All>
"""
SCHEMA = "_id INT, a STRING, b STRING"


def write(tmp_path, text):
    (tmp_path / "r.xml").write_text(text)
    return str(tmp_path)


def test_records_equal_the_built_in_reader(spark, tmp_path):
    path = write(tmp_path, ROWS)
    got = scans.scan_xml(spark, path, "x:Row", SCHEMA)
    want = spark.read.format("xml").option("rowTag", "x:Row").schema(SCHEMA).load(path)
    key = lambda df: sorted(map(tuple, df.collect()), key=repr)
    assert key(got) == key(want) and got.count() == 7
    scans.check_xml(spark, path, "x:Row")


TRICKY = """<?xml version="1.0"?><!-- </x:Row> at the top -->
<x:All xmlns:x="urn:x"><x:Row id="1"><a><![CDATA[p </x:Row> & <x:Row id="9"> q]]></a></x:Row>
<x:Row id="2"><!-- </x:Row> <x:Row id="91"> <![CDATA[ --><a>two</a><!-- c --></x:Row><?skip <x:Row id="92"><a>k</a></x:Row>?>
<!-- <x:Row id="93"><a>no</a></x:Row> <x:Row id="94"><a>no</a></x:Row> <x:Row id="95"/>
--><x:Row id="3"/><![CDATA[<x:Row id="96"><a>k</a></x:Row><!--]]><x:Row id="4" note="a > /> b"><a>four<![CDATA[]]></a><b><![CDATA[</x:Row></x:Row>--]]></b></x:Row>
<!-- </x:Row> --><!-- </x:Row> ]]> ?> --><x:Row id="5"><a>five</a></x:Row></x:All><!-- </x:Row> the end -->
"""


def test_end_tags_in_comments_and_cdata_end_no_record(spark, tmp_path):
    path = write(tmp_path, TRICKY)
    (tmp_path / "s.xml").write_text(ROWS)
    got = sorted(map(tuple, scans.scan_xml(spark, path, "x:Row", SCHEMA).collect()), key=repr)
    want = spark.read.format("xml").option("rowTag", "x:Row").schema(SCHEMA).load(path)
    assert got == sorted(map(tuple, want.collect()), key=repr) and len(got) == 12
    scans.check_xml(spark, path, "x:Row")


def test_states_pass_over_many_pieces_and_blocks(spark, tmp_path, monkeypatch):
    """A file of many blocks whose comments and CDATA sections run over several of them."""
    monkeypatch.setattr(scans, "TOGETHER", 4)
    rng = random.Random(3)
    out, ids = ["<x:All xmlns:x='urn:x'>"], []
    for i in range(900):
        kind = rng.random()
        noise = "</x:Row> " * rng.randrange(1, 60)
        if kind < 0.05:
            out.append(f"<!-- {noise} <x:Row id='{-i}'><a>no</a></x:Row> -->")
        elif kind < 0.1:
            out.append(f"<x:Row id='{i}'><a>v{i}<![CDATA[{noise}]]></a></x:Row>")
            ids.append((i, f"v{i}{noise}"))
        elif kind < 0.12:
            out.append(f"<?pi {noise} <!-- ?>")
        else:
            out.append(f"<x:Row id='{i}'><a>v{i}</a></x:Row>\n")
            ids.append((i, f"v{i}"))
    path = write(tmp_path, "".join(out) + "</x:All>")
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        df = scans.scan_xml(spark, path, "x:Row", "_id INT, a STRING")
        assert scans._text(spark, path, None, "</x:Row>").rdd.getNumPartitions() > 10
        assert sorted((r["_id"], r["a"].strip()) for r in df.collect()) == [(i, a.strip()) for i, a in ids]
        scans.check_xml(spark, path, "x:Row")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)


def test_a_plain_file_is_not_shuffled(spark, tmp_path):
    plan = scans.scan_xml(spark, write(tmp_path, ROWS.replace('<!-- <x:Row id="99"><a>no record</a></x:Row> -->', "<!-- x -->")), "x:Row", SCHEMA)
    assert "Exchange" not in plan._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("end", ["<x:Row id='1'><a>k</a><x:Row id='5'/><x:Row id='6'><a>in</a></x:Row></x:Row></x:All>", "<x:Row id='1' note='</x:Row>'><a>k</a></x:Row></x:All>", "<x:Row id='1'><a>k</a></x:Row>"])
def test_what_is_not_whole_is_reported(spark, tmp_path, end):
    with pytest.raises(ValueError, match="opened"):
        scans.check_xml(spark, write(tmp_path, "<x:All xmlns:x='urn:x'>" + end), "x:Row")


def test_unclosed_record_is_reported(spark, tmp_path):
    path = write(tmp_path, ROWS[: ROWS.index("<b>x</b>")])
    with pytest.raises(ValueError, match="opened"):
        scans.check_xml(spark, path, "x:Row")


def test_long_wire_lines_stay_whole(spark):
    line = "19990101-000000FIN" + "x" * 1_200_000
    stage = scans.classify_finwire(spark.createDataFrame([(line,)], "value string"))
    assert len(stage.first()["value"]) == 1_200_000
