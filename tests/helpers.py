"""What several test modules share and is not a fixture."""


def tuples(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
