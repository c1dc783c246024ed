import os
import tempfile

from fieldload import schemas
from fieldload.session import checkpoint_dir
from fieldload.sources.tables import read_state
from fieldload.streaming import start

from test_import_rules import LABELS, image, project, series


def test_landed_projects_are_imported_once(spark):
    root = tempfile.mkdtemp(prefix="stream-", dir=checkpoint_dir(spark).replace("file:", ""))
    template = os.path.join(root, "exports", "TABLE")
    spark.createDataFrame([series("a", ["i1"]), series("b", ["i2"])], schemas.TIMESERIES).write.parquet(
        template.replace("TABLE", "timeseries")
    )
    spark.createDataFrame([image("i1"), image("i2")], schemas.IMAGES_METADATA).write.parquet(
        template.replace("TABLE", "images_metadata")
    )
    labels = os.path.join(root, "labels")
    spark.createDataFrame(LABELS, schemas.LABELS).write.parquet(labels)
    projects = template.replace("TABLE", "projects")
    spark.createDataFrame([project("1", ["a"])], schemas.PROJECTS).write.mode("append").parquet(projects)
    warehouse = os.path.join(root, "warehouse")
    ckpt = os.path.join(root, "stream-ckpt")

    q = start(spark, template, labels, warehouse, ckpt, "2025-01-01 00:00:00")
    q.awaitTermination(300)
    assert sorted(r.ext_id for r in read_state(spark, warehouse).timeseries.collect()) == ["a"]

    spark.createDataFrame([project("2", ["a", "b"])], schemas.PROJECTS).write.mode("append").parquet(projects)
    q = start(spark, template, labels, warehouse, ckpt, "2025-01-01 00:00:00")
    q.awaitTermination(300)
    st = read_state(spark, warehouse)
    assert sorted(r.ext_id for r in st.timeseries.collect()) == ["a", "b"]
    assert sorted(r.ext_id for r in st.dataset.collect()) == ["1", "2"]
