from presswerk.plans import registry
from presswerk.session import read_table


def test_every_hit_is_written(spark, small):
    key = ["retrieval_run_id", "interest", "rank"]
    written = registry.QUERIES["g10_write"](spark, small)
    hits = read_table(spark, small, "retrieval_hits").select(*key, "article_id")
    got = sorted(map(tuple, written.select(*key, "id").collect()))
    assert got == sorted(map(tuple, hits.collect())) and max(r[2] for r in got) > 3
