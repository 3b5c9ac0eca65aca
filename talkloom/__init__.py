"""talkloom: Spark jobs that turn social posts and uploads into labelled text corpora.

Every public function takes and returns DataFrames (or Columns), so a stage is a
plain ``df.transform`` chain and Catalyst sees one plan up to the sink.
"""

from talkloom.session import prepare_session

__all__ = ["prepare_session"]
