"""The operators applied to the given tables, one query each, with SQL where it can say the same."""

from __future__ import annotations

from wattline.llm.common import read_table
from wattline.llm.exact_dedup import EXACT_SQL, exact_duplicates
from wattline.llm.html import extract_main_text
from wattline.llm.line_dedup import kept_lines
from wattline.llm.merkle import MERKLE_SQL, verified_manifest
from wattline.llm.mixing import MIX_SQL, mix_plan
from wattline.llm.ngram_join import similar_documents
from wattline.llm.packing import pack_documents
from wattline.llm.periodic import run_report
from wattline.llm.personal_data import personal_data_report
from wattline.llm.phrases import PHRASES_SQL, remove_repeated_passages
from wattline.llm.topk import TOPK_SQL, top_k
from wattline.llm.toxicity import score_toxicity
from wattline.llm.warc import WARC_SQL, archived_pages, write_warc
from wattline.session import work_folder


def op1_html_extraction(spark, folder):
    return extract_main_text(read_table(spark, folder, "pages"))


def op2_toxicity(spark, folder):
    return score_toxicity(read_table(spark, folder, "documents"), read_table(spark, folder, "labels"))


def op3_ngram_join(spark, folder):
    return similar_documents(read_table(spark, folder, "documents"))


def op4_topk(spark, folder):
    return top_k(read_table(spark, folder, "embeddings"))


def op5_line_dedup(spark, folder):
    return kept_lines(read_table(spark, folder, "documents")).drop("doc_key")


def op6_exact_dedup(spark, folder):
    return exact_duplicates(spark, f"{folder}/documents.parquet")


def op7_mixing(spark, folder):
    return mix_plan(read_table(spark, folder, "documents"))


def op8_warc(spark, folder):
    archives = work_folder(spark, "archives")
    write_warc(read_table(spark, folder, "pages"), archives)
    return archived_pages(spark, archives)


def op9_substring_dedup(spark, folder):
    return remove_repeated_passages(read_table(spark, folder, "documents"))


def op10_packing(spark, folder):
    return pack_documents(read_table(spark, folder, "documents"))


def op11_periodic_runs(spark, folder):
    return run_report(read_table(spark, folder, "documents"))


def op12_merkle_manifest(spark, folder):
    return verified_manifest(read_table(spark, folder, "documents"))


def op13_personal_data(spark, folder):
    return personal_data_report(read_table(spark, folder, "documents"))


QUERIES = {
    "op1_html_extraction": op1_html_extraction,
    "op2_toxicity": op2_toxicity,
    "op3_ngram_join": op3_ngram_join,
    "op4_topk": op4_topk,
    "op5_line_dedup": op5_line_dedup,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_mixing": op7_mixing,
    "op8_warc": op8_warc,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_packing": op10_packing,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_personal_data": op13_personal_data,
}

ORACLES = {
    "op4_topk": TOPK_SQL,
    "op6_exact_dedup": EXACT_SQL,
    "op7_mixing": MIX_SQL,
    "op8_warc": WARC_SQL,
    "op9_substring_dedup": PHRASES_SQL,
    "op12_merkle_manifest": MERKLE_SQL,
}
