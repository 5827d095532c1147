"""Connected components of a graph given as edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayline.session import materialize


def components(edges: DataFrame) -> DataFrame:
    """(id, comp) for every id of ``edges`` (a, b): comp is the component's least id.

    Every round takes the least label among an id's neighbours, then the label
    of its label, so that the distance to the least id shrinks by more than
    half; rounds end when no label has changed.  Each round is written to the
    shared folder.  Labels of a hub's neighbours are met by map-side minima."""
    both = materialize(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
                       .filter("a <> b").distinct(), "edges")
    labels = materialize(both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("m"))
                         .select("id", F.least("id", "m").alias("comp")), "labels")
    while True:
        near = (both.join(labels, both["b"] == labels["id"]).groupBy("a").agg(F.min("comp").alias("m")))
        step = labels.join(near, labels["id"] == near["a"]).select(
            "id", F.col("comp").alias("was"), F.least("comp", "m").alias("comp"))
        up = labels.select(F.col("id").alias("up_id"), F.col("comp").alias("up"))
        step = step.join(up, step["comp"] == up["up_id"], "left").select(
            "id", "was", F.least("comp", F.coalesce("up", "comp")).alias("comp"))
        step = materialize(step, "labels")
        labels = step.select("id", "comp")
        if step.filter("comp <> was").isEmpty():
            return labels
