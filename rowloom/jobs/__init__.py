from rowloom.jobs.reach import active_sources, reach
from rowloom.jobs.word_count import word_cells, word_count_cells, word_state

__all__ = ["active_sources", "reach", "word_cells", "word_count_cells", "word_state"]
