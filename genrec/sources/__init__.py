from genrec.sources.views import movies_view, ratings_view, read_table

__all__ = ["movies_view", "ratings_view", "read_table"]
