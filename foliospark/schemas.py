"""Spark schemas of the data model."""

from __future__ import annotations

from pyspark.sql import types as T


_SIMPLE = {"string": T.StringType, "int": T.IntegerType, "long": T.LongType, "double": T.DoubleType, "float": T.FloatType, "boolean": T.BooleanType}


def _fields(text: str) -> list[str]:
    """The parts of a list at its top level."""
    parts, depth, start = [], 0, 0
    for i, c in enumerate(text):
        depth += (c == "<") - (c == ">")
        if c == "," and depth == 0:
            parts.append(text[start:i].strip())
            start = i + 1
    return [*parts, text[start:].strip()]


def _type(text: str) -> T.DataType:
    name, _, inner = text.partition("<")
    inner = inner[:-1]
    if name == "array":
        return T.ArrayType(_type(inner))
    if name == "map":
        return T.MapType(*map(_type, _fields(inner)))
    if name == "struct":
        return T.StructType([T.StructField(f.partition(":")[0], _type(f.partition(":")[2])) for f in _fields(inner)])
    return _SIMPLE[name]()


def struct(ddl: str) -> T.StructType:
    """A schema from "name type, ..."; unlike StructType.fromDDL this needs no session when the module is imported."""
    return T.StructType([T.StructField(f.partition(" ")[0], _type(f.partition(" ")[2])) for f in _fields(ddl)])


METRIC = "struct<name:string,value_raw:string,dataset:string,split:string,conditions:string>"
AUTHOR = "struct<name:string,affiliations:array<string>,email:string,is_corresponding:boolean>"
INSTITUTION = "struct<name:string,department:string,country:string>"
DATASET = "struct<name:string,description:string,size:string,source_url:string,split_info:string>"
METHOD = "struct<name:string,description:string,novelty:string,components:array<string>>"
RESULT = f"struct<method_name:string,metrics:array<{METRIC}>,dataset:string,is_proposed:boolean>"
BASELINE = f"struct<name:string,citation:string,metrics:array<{METRIC}>,notes:string>"
LIMITATION = "struct<description:string,type:string,is_author_stated:boolean>"

#: Fixed values.
SCALARS = ("title", "problem_statement", "abstract", "conclusion_summary", "arxiv_id")
LISTS = {"authors": AUTHOR, "institutions": INSTITUTION, "datasets": DATASET, "methods": METHOD, "results": RESULT, "baselines": BASELINE, "limitations": LIMITATION}
CONFIDENCE_FIELDS = ("title", "authors", "datasets", "methods", "results", "baselines", "limitations", "problem_statement")
LIMITATION_TYPES = ("data", "methodology", "compute", "generalization", "evaluation", "other")
FIELD_CONFIDENCE = f"struct<{','.join(f'{c}:double' for c in CONFIDENCE_FIELDS)}>"

PARTIAL_DDL = ", ".join(["doc_id string", "partial_idx int", *(f"{c} string" for c in SCALARS), *(f"{c} array<{t}>" for c, t in LISTS.items()), "extraction_confidence double", f"field_confidence {FIELD_CONFIDENCE}"])
PARTIAL = struct(PARTIAL_DDL)

PAPER_META = struct("arxiv_id string, title string, authors array<string>, abstract string, categories array<string>, pdf_url string, published string, updated string, local_pdf_path string")
BLOCKS = struct("doc_id string, page_idx int, page_number int, block_idx int, block_type string, content string")
CHUNKS = struct("doc_id string, chunk_id string, section string, section_type string, chunk_type string, content string, page_numbers array<int>, word_count int, block_type string, ordinal int")
VECTORS = struct("chunk_id string, text string, embedding array<float>, metadata map<string,string>")
NODES = struct("label string, key string, props map<string,string>")
EDGES = struct("edge_id string, rel_type string, src_label string, src_key string, dst_label string, dst_key string, props map<string,string>")
HITL_QUEUE = struct("field_name string, field_value string, candidate_types array<string>, confidence double, reason string")
EXTRACTION_LOG = struct("doc_id string, page_idx int, raw_text string, prompt_tokens int, completion_tokens int, latency_ms double, model string, success boolean, error string")
VIOLATIONS = struct("doc_id string, inconsistency_type string, field_name string, value string, severity double, description string")
FLAGS = struct("doc_id string, hallucination_type string, field_name string, flagged_value string, confidence double")
