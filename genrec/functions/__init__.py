from genrec.functions.genres import (
    BLANK_GENRES, EXCLUDED_GENRE, clean_genres, coefficient, parse_pipe, pipe_string,
    title_year,
)

__all__ = ["BLANK_GENRES", "EXCLUDED_GENRE", "clean_genres", "coefficient", "parse_pipe",
           "pipe_string", "title_year"]
