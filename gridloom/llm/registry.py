"""The subpackage's queries and their SQL, for __spark_entry__.py."""

from gridloom.llm import bpe, caps, langid, licenses, mixing, routing, simhash, substring, toxicity, warc

QUERIES = {
    "op1_toxicity": toxicity.op1_toxicity,
    "op2_bpe": bpe.op2_bpe,
    "op3_warc": warc.op3_warc,
    "op4_substring_dedup": substring.op4_substring_dedup,
    "op5_language_id": langid.op5_language_id,
    "op6_embedding_dedup": caps.op6_embedding_dedup,
    "op7_mixing": mixing.op7_mixing,
    "op8_simhash": simhash.op8_simhash,
    "op9_license_scan": licenses.op9_license_scan,
    "op10_nearest": routing.op10_nearest,
}
ORACLE_SQL = {"op6_embedding_dedup": caps.ORACLE_SQL, "op9_license_scan": licenses.ORACLE_SQL, "op3_warc": warc.ORACLE_SQL, "op7_mixing": mixing.ORACLE_SQL, "op4_substring_dedup": substring.ORACLE_SQL}
