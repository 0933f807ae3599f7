import pytest
from pyspark.sql import functions as F

from meterlake.llm import fixity as M
from tests.llm.helpers import bag, empty

PAGES = "page_id long, url string, html string, file string, digest string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "mine", "mine") for r in rows], PAGES)


def laid_out(spark, rows, per_file=100):
    return M.lay_out(M.page_records(pages(spark, rows), per_file))


ROWS = [(i, f"http://h/{i}", "x" * (37 * i % 900)) for i in range(350)]


@pytest.mark.parametrize("range_bytes, fanout", [(1 << 16, 16), (700, 2), (100, 3)])
def test_damage_is_found_and_nothing_else(spark, range_bytes, fanout):
    sound = laid_out(spark, ROWS).checkpoint()
    broken = sound.where("page_id NOT IN (17, 349)").withColumn(
        "digest", F.when(F.col("page_id").isin(0, 101, 102), F.sha2("digest", 256)).otherwise(F.col("digest"))
    )
    kept = sound.where("page_id != 220")
    got = M.audit(kept, broken, range_bytes, fanout).collect()
    want = [(f"urn:page:{i}", s) for i, s in [(17, "missing"), (349, "missing"), (0, "changed"), (101, "changed"), (102, "changed"), (220, "extra")]]
    assert bag((r.record_id, r.status) for r in got) == bag(want)
    place = {r.record_id: (r.file, r.offset) for r in sound.collect()}
    assert all((r.file, r.offset) == place[r.record_id] for r in got)
    assert M.audit(sound, sound.repartition(3), range_bytes, fanout).count() == 0


def test_offsets_are_running_sums_and_records_are_bytes(spark):
    rows = [(5, "u", "é"), (1, None, None), (None, None, ""), (1, None, None), (1, None, None)]
    got = laid_out(spark, rows).orderBy("file", "offset").collect()
    one = len("WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:1>\r\nWARC-Target-URI: \r\nContent-Length: 0\r\n\r\n\r\n\r\n")
    assert [(r.file, r.offset, r.length) for r in got] == [
        ("crawl-00000000.warc", 0, one), ("crawl-00000000.warc", one, one), ("crawl-00000000.warc", 2 * one, one),
        ("crawl-00000000.warc", 3 * one, one + 1 + 2), ("crawl-none.warc", 0, one + 3),
    ]


def test_a_repeated_place_counts_its_copies(spark):
    sound = laid_out(spark, ROWS[:20])
    twice = sound.unionByName(sound.where("page_id = 3"))
    got = M.audit(sound, twice, 500, 2).collect()
    assert [(r.record_id, r.status) for r in got] == [("urn:page:3", "changed")]


def test_empty_replicas(spark):
    sound = laid_out(spark, ROWS[:30])
    none = M.lay_out(M.page_records(empty(spark, PAGES)))
    assert M.audit(none, none).count() == 0
    assert {r.status for r in M.audit(sound, none).collect()} == {"missing"}
    assert M.audit(none, sound, 300, 2).where("status = 'extra'").count() == 30
