"""E1 property: the Spark type label equals the route's labelling on generated names.

The specification below is written from the route's behaviour: a falsy name is
``unknown``; otherwise the name is stripped of white space (as Python's ``strip``), must
end with ``)``, and the label is the text after the first ``(`` that follows the last
``)`` before the final one, lower-cased; anything else is ``other``.
"""

from hypothesis import given, settings
from hypothesis import strategies as st

from clinark.functions import exprs as X

# Characters that stress the label (parentheses, blanks Python strips,
# a non-blank control, letters with special lower-casing).
ALPHABET = ["(", ")", "a", "B", " ", "\u00a0", "\x1c", "\x1f", "\x1b", "\n", "\u2028",
            "\u3000", "\u0130", "\u03a3", "x"]


def spec_label(name):
    if not name:
        return "unknown"
    s = name.strip()
    if not s.endswith(")"):
        return "other"
    body = s[:-1]
    open_at = body.find("(", body.rfind(")") + 1)
    if open_at < 0 or open_at == len(body) - 1:
        return "other"
    return body[open_at + 1:].lower()


names = st.lists(st.text(alphabet=st.sampled_from(ALPHABET), max_size=12),
                 min_size=50, max_size=200)


@settings(max_examples=8, deadline=None)
@given(names)
def test_label_matches_specification(spark, batch):
    batch = batch + ["", None, "Foo (x) ", "A (a (b)"]
    df = spark.createDataFrame([(i, n) for i, n in enumerate(batch)], "i int, name string")
    got = [r[0] for r in df.orderBy("i").select(X.condition_type("name")).collect()]
    assert got == [spec_label(n) for n in batch]
