"""Helpers of the tests; a module of its own, as every folder has a conftest."""


def rows_of(df, *names):
    return sorted((tuple(r) for r in df.select(*[f"`{n}`" for n in names or df.columns]).collect()), key=repr)
