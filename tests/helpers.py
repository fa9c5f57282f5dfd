"""What several test modules use."""

from pricetide import manifest


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def leaf(spark, root, day):
    """The folder that the newest version names for a date."""
    return f"{root}/{manifest.current(spark, root).parts[str(day)]}"
