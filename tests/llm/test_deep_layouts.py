"""Containers at any depth tell layouts apart."""

from test_wrappers import _texts

from lingualake.llm import pages


def _nested(tags, inner):
    return "".join(f"<{t}>" for t in tags) + inner + "".join(f"</{t}>" for t in reversed(tags))


def test_layouts_that_differ_below_twelve_containers(spark):
    """containers below the twelfth were left out, so the template of the fewer pages was taken for their text."""
    few = _nested(["div"] * 14 + ["section", "center"] * 7, "<div><p>Printed by the press</p></div><div><h1>F{0}</h1><p>few {0}</p></div>")
    many = _nested(["div"] * 14 + ["table", "tr", "td"] * 5, "<div><h1>M{0}</h1><p>many {0}</p></div>")
    got = _texts(spark, [few.format(i) for i in range(4)] + [many.format(i) for i in range(9)])
    assert got == [f"F{i}\n\nfew {i}" for i in range(4)] + [f"M{i}\n\nmany {i}" for i in range(9)]


def test_outline_of_all_containers():
    """the outline ended at the twelfth container."""
    assert pages.layout([("div",) * 14 + ("ul", "p"), ("div",) * 13 + ("section",)]) == "div(" * 14 + ")section()" + ")" * 13
    assert pages.layout([]) == ""


def test_pages_nested_thousands_deep(spark):
    """what is compared has no depth at which it ends or fails."""
    deep = "div(" * 5000 + "{0}" + ")" * 5000
    a, b, c = (deep.format(x) for x in ("section()", "table(tr(td()))", ""))
    assert pages.group_layouts([a, b, c, "div(" * 2000 + ")" * 2000, "main()"]) == [a, a, a, "div(" * 2000 + ")" * 2000, "main()"]
    size, pairs = pages.match(pages.outline(a, {})[0], pages.outline(b, {})[0])
    assert size == len(pairs) == 5001
    rows = [_nested(["div"] * 3000, f"<div><p>Imprint</p></div><div><p>text {i}</p></div>") for i in range(5)]
    assert _texts(spark, rows) == [f"text {i}" for i in range(5)]
