from millrace.operators.distinct import distinct_names, distinct_rows
from millrace.operators.joins import Match, attach, measure
from millrace.operators.keys import dense_key, occurrence_key

__all__ = ["Match", "attach", "dense_key", "distinct_names", "distinct_rows", "measure", "occurrence_key"]
