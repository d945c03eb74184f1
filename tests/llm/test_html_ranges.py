"""The nearest page does not depend on how the table is cut into ranges."""

import pytest

from rigprep.llm import html_text


@pytest.mark.parametrize("rows_per_part", [1, 2, 3, 7])
def test_pages_at_the_edge_of_a_range_have_both_neighbours(spark, rows_per_part):
    urls = [f"http://h{h}.org/{'abc'[k % 3]}/{k // 2}/x{k}" for h, n in enumerate((1, 2, 5, 12, 2, 1, 3)) for k in range(n)]
    urls += [None, "odd", "http://h3.org/a/0/x0"]
    pages = spark.createDataFrame(list(enumerate(urls)), "row long, url string").repartition(3)

    def mates(n):
        return {r.row: r.mate for r in html_text.nearest(pages, n).collect()}

    whole = mates(1000)
    assert whole[0] is None and {whole[1], whole[2]} == {1, 2} and len(whole) == len(urls)
    assert mates(rows_per_part) == whole
