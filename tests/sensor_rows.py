"""What the tests share besides fixtures; the name is unique, as test folders are on one path."""

SMALL = "/root/testdata/sf0.001"


def rows(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()),
                  key=lambda r: tuple((v is None, str(type(v)), v) for v in r))
