from __future__ import annotations

from vintagelens.llm import lines


def test_copies_of_lines_of_every_length(spark):
    docs = [
        (1, "Released under the MIT License.\n中文的一行没有空格\nYes.\n\n1 2 3 4 5 6\nonly here"),
        (2, "All rights reserved. 2001\nYes.\n\n1 2 3 4 5 7\nno\nRun 1 of 2 a b"),
        (3, "中文的一行没有空格\nYes.\nAll rights reserved. 2002\n 1  2 3 4 5 6\nRun 7 of 9 a b\nno"),
        (4, "Released under  the MIT License.\nYes.\nAll rights reserved. 2001\n\nRun 1 of 2 a b"),
        (4, "Yes.\nnever\nnever\nnever"),
    ]
    rows = lines.dedup(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    found = {(r.doc_id, r.n_lines): r.dropped for r in rows}
    # 'no' stands in two documents only, blank lines stay, and other digits are another line.
    assert found == {(1, 6): [], (2, 6): [1], (3, 6): [0, 1, 3], (4, 5): [0, 1, 2, 4], (4, 4): [0]}
