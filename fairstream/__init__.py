"""fairstream: fair clustering of labelled points and item counting on streams,
as Spark DataFrame, Spark ML and Structured Streaming jobs.

    from fairstream.session import get_session
    from fairstream.sources import points, items
    from fairstream.operators import cluster, fair, metrics, sketch, topk
    from fairstream.functions import hashing

    spark = get_session()
    pts = points.read_points(spark, "hdfs:///data/points.csv")          # x,y,label lines
    centres = fair.fair_kmeans(pts, k=4, rounds=10, seed=42)
    metrics.summary(pts, centres).show()                                 # N, NA, NB, Delta, Phi

    cm_spec, cs_spec = hashing.hash_family(depth=5, width=50, seed=7)
    cm = sketch.Sketch("cm", cm_spec)
    cs = sketch.Sketch("cs", cs_spec, signed=True)
    topk.hitter_report(items_df, k=10, cm=cm, cs=cs).show()

See README.md for the operator map and how each job behaves at scale.
"""

__version__ = "0.1.0"
