"""genrec: genre-correlation recommendation on Spark DataFrames.

Layout:
  sources/    driver tables -> movies/ratings views, CSV readers and writers
  functions/  column expressions (genre lists, titles, pipe strings, coefficients)
  operators/  DataFrame -> DataFrame steps: preparation, model, scoring, metrics, serving
  plans/      end-to-end jobs and the query catalogue used by ``__spark_entry__``
  llm/        operators for training-data pipelines (not imported by the rest)

No function in the package triggers an action, collects to the driver or uses
Python in tasks unless its docstring, or its module's, says so.
"""

from genrec.session import ensure_checkpoint_dir, local_session

__all__ = ["ensure_checkpoint_dir", "local_session"]
