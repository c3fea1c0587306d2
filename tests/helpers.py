"""What several test modules share."""


def rows_of(frame, *columns):
    """The rows as a sorted list of tuples."""
    frame = frame.select(*columns) if columns else frame.select(*sorted(frame.columns))
    return sorted((tuple(r) for r in frame.collect()), key=lambda r: tuple((x is None, str(x)) for x in r))
