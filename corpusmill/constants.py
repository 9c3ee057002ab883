"""Fixed values. These must stay exactly as they are: results depend on them."""

from __future__ import annotations

# --- fixed values: chunking and search parameters -------------------------------
CHUNK_TOKENS = 384
CHUNK_OVERLAP = 128
ANN_RESULTS = 16
TRIAL_RESULTS = 3
SCORE_THRESHOLD = 0.1
PRECISION_CUT = 0.5
USER_SLUG_CHARS = 35

# --- fixed values: prompt templates ----------------------------------------------
CHUNK_TEMPLATE = "Passage text: {chunk_text}\nPassage metadata: {metadata}\n\n"

PROMPT_TEMPLATE = (
    "Use the following pieces of retrieved context to answer the question.\n"
    "Only use the passages from context that are relevant to the query to answer the question, "
    "ignore the irrelevant passages \n\nContext: {context}"
)

CITING_PROMPT_TEMPLATE = (
    "Use the following pieces of retrieved context to answer the question.\n"
    "Only use the passages from context that are relevant to the query to answer the question, "
    "ignore the irrelevant passages.  When responding, cite your source, referring to the passage "
    "by the columns in the passage's metadata.\n\nContext: {context}"
)

SYSTEM_PROMPT = (
    "You are a helpful assistant that answers questions by calling tools.  Provide responses ONLY "
    "based on the information from tools that are explictly specified to you.  If you do not have a "
    "relevant tool for a question, respond with 'Sorry, I'm not trained to answer that question'."
)

# --- fixed values: parser status ---------------------------------------------------
SUCCESS = "SUCCESS"
ERROR_PREFIX = "ERROR: An error occurred: "
NO_PARSER = "No supported parser for "
BAD_UTF8 = "content is not valid UTF-8"
NO_TEXT = "the parser gave no text"

# --- fixed values: labels ------------------------------------------------------------
IMPROVE_RETRIEVAL = "Improve Retrieval"
IMPROVE_GENERATION = "Improve Generation"
PASSED = "No root cause, record passed"

# --- fixed values: rules without ground truth ---------------------------------------------
# (precision side, groundedness, relevance) -> root cause, assessment, rationale
RULES_WITHOUT_TRUTH = [
    ("low", "no", "no", IMPROVE_RETRIEVAL, "fail",
     "Retrieval quality is poor."),
    ("low", "no", "yes", IMPROVE_RETRIEVAL, "fail",
     "Retrieval quality is poor."),
    ("low", "yes", "no", IMPROVE_RETRIEVAL, "fail",
     "Response is grounded in retrieval, but retrieval is poor."),
    ("low", "yes", "yes", IMPROVE_RETRIEVAL, "pass",
     "Relevant response grounded in the retrieved context and relevant, but retrieval is poor."),
    ("high", "no", "no", IMPROVE_GENERATION, "fail",
     "Hallucination"),
    ("high", "no", "yes", IMPROVE_GENERATION, "fail",
     "Hallucination"),
    ("high", "yes", "no", IMPROVE_GENERATION, "fail",
     "Good retrieval & grounded, but LLM does not provide a relevant response."),
    ("high", "yes", "yes", PASSED, "pass",
     "Good retrieval and relevant response. Collect ground-truth to know if the answer is correct."),
]

# --- fixed values: rules with ground truth ------------------------------------------------------
# (precision side, groundedness, correctness, relevance or None) -> root cause, assessment, rationale
RULES_WITH_TRUTH = [
    ("low", "no", "no", "no", IMPROVE_RETRIEVAL, "fail",
     "Retrieval is poor."),
    ("low", "no", "no", "yes", IMPROVE_RETRIEVAL, "fail",
     "LLM generates relevant response, but retrieval is poor e.g., the LLM ignores retrieval and "
     "uses its training knowledge to answer."),
    ("low", "no", "yes", None, IMPROVE_RETRIEVAL, "fail",
     "Retrieval quality is poor, but LLM gets the answer correct regardless."),
    ("low", "yes", "no", "no", IMPROVE_RETRIEVAL, "fail",
     "Response is grounded in retrieval, but retrieval is poor."),
    ("low", "yes", "no", "yes", IMPROVE_RETRIEVAL, "fail",
     "Relevant response grounded in the retrieved context, but retrieval may not be related to the "
     "expected answer."),
    ("low", "yes", "yes", None, PASSED, "pass",
     "Retrieval finds enough information for the LLM to correctly answer."),
    ("high", "no", "no", None, IMPROVE_GENERATION, "fail",
     "Hallucination"),
    ("high", "no", "yes", None, IMPROVE_GENERATION, "fail",
     "Hallucination, correct but generates details not in context"),
    ("high", "yes", "no", "no", IMPROVE_GENERATION, "fail",
     "Good retrieval, but the LLM does not provide a relevant response."),
    ("high", "yes", "no", "yes", IMPROVE_GENERATION, "fail",
     "Good retrieval and relevant response, but not correct."),
    ("high", "yes", "yes", "yes", PASSED, "pass",
     "No issues."),
]

# --- fixed values: long result-column names and the short names used inside --------------------------
REPORT_NAMES = {
    "root_cause": "overall/root_cause/rating",
    "assessment": "overall/assessment",
    "rationale": "overall/root_cause/rationale",
    "relevance": "response/llm_judged/relevance_to_query/rating",
    "relevance_rationale": "response/llm_judged/relevance_to_query/rationale",
    "groundedness": "response/llm_judged/groundedness/rating",
    "groundedness_rationale": "response/llm_judged/groundedness/rationale",
    "correctness": "response/llm_judged/correctness/rating",
    "correctness_rationale": "response/llm_judged/correctness/rationale",
    "ratings": "retrieval/llm_judged/chunk_relevance/ratings",
    "rationales": "retrieval/llm_judged/chunk_relevance/rationales",
    "precision": "retrieval/llm_judged/chunk_relevance/precision",
}

# --- fixed values: columns of the detail report, in display order ------------------------------------
REPORT_COLUMNS = [
    "request_id",
    "overall/root_cause/rating",
    "overall/assessment",
    "overall/root_cause/rationale",
    "trace",
    "expected_retrieved_context",
    "expected_response",
    "response/llm_judged/relevance_to_query/rating",
    "response/llm_judged/relevance_to_query/rationale",
    "response/llm_judged/groundedness/rating",
    "response/llm_judged/groundedness/rationale",
    "retrieval/llm_judged/chunk_relevance/ratings",
    "retrieval/llm_judged/chunk_relevance/rationales",
    "retrieval/llm_judged/chunk_relevance/precision",
]

# --- fixed values: columns shown for inspection, and columns of the saved evaluation set
INSPECT_COLUMNS = [
    "request_id", "request", "response", "trace", "expected_response", "expected_retrieved_context", "is_correct",
]
SAVED_COLUMNS = [
    "request", "request_id", "expected_response", "expected_retrieved_context", "source_user", "source_tag",
]
