import hashlib

from scoreflow.catalog.feeds import table
from scoreflow.catalog.queries import QUERIES


def test_page_images_are_read_in_few_tasks(spark, sf_dir):
    """With files packed four to a task (as under a 16 MB split), the image scan used to run about a
    task for each four pages; now it runs in as many tasks as the pages, with every page read."""
    pages = table(spark, sf_dir, "pages")
    tasks = max(pages.rdd.getNumPartitions(), spark.sparkContext.defaultParallelism)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16m")
    try:
        for name in ("image_read", "image_stream"):
            got = QUERIES[name](spark, sf_dir)
            if name == "image_read":
                assert got.rdd.getNumPartitions() <= tasks
            rows = {r.page_id: (r.width, r.height, r.channels, r.pixels_md5) for r in got.collect()}
            expected = {
                r.page_id: (len(r.html.encode()), 1, 1, hashlib.md5(r.html.encode()).hexdigest())
                for r in pages.collect()
            }
            assert rows == expected, name
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
