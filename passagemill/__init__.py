"""passagemill: documents in, searchable passages and answered questions out.

Every public function takes and returns DataFrames. The heavy stages are
row-local (parse, chunk, embed) so they run without a shuffle; search keeps a
running top-k per task and only shuffles the winners.
"""

__version__ = "0.1.0"
