"""The registered queries of this package and their SQL."""

from . import bpe, decontaminate, embed_dedup, hard_negatives, html_text, language, lines, secrets, simhash, spelling, suffix, topk, toxicity

QUERIES = {
    f.__name__: f
    for f in (
        language.op1_language_id,
        toxicity.op2_toxicity,
        html_text.op3_html_text,
        secrets.op4_secrets,
        bpe.op5_bpe,
        suffix.op6_suffix_dedup,
        lines.op7_line_dedup,
        topk.op8_topk,
        decontaminate.op9_decontamination,
        simhash.op10_simhash,
        embed_dedup.op11_embed_dedup,
        hard_negatives.op12_hard_negatives,
        spelling.op13_spelling_variants,
    )
}
ORACLE = {
    "op4_secrets": secrets.SQL,
    "op7_line_dedup": lines.SQL,
    "op11_embed_dedup": embed_dedup.SQL,
    "op12_hard_negatives": hard_negatives.SQL,
    "op13_spelling_variants": spelling.SQL,
}
