"""parcelflow: capture and analyse keyed JSON commerce events on Spark.

Every public function takes and returns Spark DataFrames (or a streaming
query), so results can be combined freely with the rest of the DataFrame API.
"""

from parcelflow.session import configure, new_session, scratch_dir

__all__ = ["configure", "new_session", "scratch_dir"]
