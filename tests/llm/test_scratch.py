import os

from ledgerlark.llm import near_dedup


def test_registers_by_document_leave_the_disk(spark):
    """Once nodes hold the registers, the sketches by document are gone, and the result doesn't read them."""
    shared = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(shared)) if os.path.isdir(shared) else set()
    texts = [(1, "a b c d e f g"), (2, "a b c d e f g"), (3, "q r s t u v w"), (4, None), (None, "a b c d e f g")]
    found = near_dedup.near_copies(spark, spark.createDataFrame(texts, "doc_id long, text string"))
    new = {name.rsplit("-", 1)[0].split("-")[0] for name in set(os.listdir(shared)) - before}
    assert "nodes" in new and "sketches" not in new
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in found.collect()}
    assert got == {1: (3, 1, True), 2: (3, 1, False), 3: (3, 3, True), 4: (0, 4, True), None: (3, None, True)}
