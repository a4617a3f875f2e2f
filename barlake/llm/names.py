"""Column names as references."""


def quoted(name: str) -> str:
    """A reference to the column of exactly this name, dots and backticks included."""
    return "`" + name.replace("`", "``") + "`"
