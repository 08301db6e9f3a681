"""The queries and SQL that __spark_entry__ adds when this folder is there."""

from .op01_token_counts import op1_token_counts
from .op02_sentencepiece import op2_sentencepiece
from .op03_minhash import op3_minhash
from .op04_token_ids import op4_token_ids
from .op05_licences import op5_licences
from .op06_urls import op6_urls
from .op07_language import op7_language
from .op08_secrets import op8_secrets
from .op09_decontaminate import OP9_SQL, op9_decontaminate
from .op10_embeddings import op10_embeddings

QUERIES = {
    "op1_token_counts": op1_token_counts,
    "op2_sentencepiece": op2_sentencepiece,
    "op3_minhash": op3_minhash,
    "op4_token_ids": op4_token_ids,
    "op5_licences": op5_licences,
    "op6_urls": op6_urls,
    "op7_language": op7_language,
    "op8_secrets": op8_secrets,
    "op9_decontaminate": op9_decontaminate,
    "op10_embeddings": op10_embeddings,
}
ORACLE_SQL = {"op9_decontaminate": OP9_SQL}
