"""hirescope: a Spark-native job-postings analytics engine.

Everything is expressed as DataFrame / SQL transformations (Column -> Column
and DataFrame -> DataFrame helpers) so Catalyst can prune, push down and
code-generate the whole pipeline.  Rule lists live as data in
``hirescope.functions.rules``.
"""

from hirescope.session import get_spark, checkpoint_dir

__all__ = ["get_spark", "checkpoint_dir"]
