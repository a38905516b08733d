import re

import __spark_entry__ as E


def test_one_query_of_each_number_and_the_pipeline():
    numbers = [int(m[1]) for n in E.queries() if (m := re.match(r"op(\d+)_", n))]
    assert sorted(numbers) == list(range(1, 14)) and "pipeline" in E.queries()
    assert {"op4_chat_format", "op8_url_rules", "op12_ns_kmeans", "op13_minhash"} <= set(E.oracle_sql())
