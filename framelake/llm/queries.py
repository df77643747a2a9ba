"""The text operators' queries, each over its whole table, and their SQL where SQL can express them."""

from __future__ import annotations

from framelake.llm import arrow_seq, bpe, decontam, divergence, langid, licenses, merkle, neardup, quality, secrets, substring, urls, warc

QUERIES = {
    "op1_line_quality": quality.query,
    "op2_license_dice": licenses.query,
    "op3_language_mixture": langid.query,
    "op4_byte_bpe": bpe.query,
    "op5_url_aliases": urls.query,
    "op6_order_minhash": neardup.query,
    "op7_arrow_sequences": arrow_seq.query,
    "op8_warc_dictionary": warc.query,
    "op9_repeated_phrases": substring.query,
    "op10_pigeonhole_leaks": decontam.query,
    "op11_secret_crf": secrets.query,
    "op12_merkle_manifest": merkle.query,
    "op13_source_divergence": divergence.query,
}
ORACLE_SQL = {
    "op1_line_quality": quality.SQL,
    "op5_url_aliases": urls.SQL,
    "op8_warc_dictionary": warc.SQL,
    "op12_merkle_manifest": merkle.SQL,
    "op13_source_divergence": divergence.SQL,
}
