"""wordmill — a Spark-native engine for preparing text corpora.

Every operator is a ``DataFrame -> DataFrame`` or ``Column -> Column``
function built on Spark's own expressions, so Catalyst can push filters,
prune columns and fuse the per-document work into whole-stage codegen.
"""

__version__ = "0.1.0"
