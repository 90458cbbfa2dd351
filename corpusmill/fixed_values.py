"""The names, patterns, limits and wordings that users' data sets depend on.

Everything here has to keep its exact value for results to stay comparable with
data sets made elsewhere. Regular expressions are written for java.util.regex.
"""

# ---- text classes -----------------------------------------------------------
# Unicode white space as str.split()/str.strip() see it, and word characters.
WS = r"[\s\x0b\x1c-\x1f\x85\p{Z}]"
WORD = r"[\p{L}\p{N}_]"

# ---- file scan --------------------------------------------------------------
# Extension order is record order: code files first, then documentation.
CODE_EXTENSIONS = ("sv", "v", "svh")
DOC_EXTENSIONS = ("md", "rst")

# ---- record types -----------------------------------------------------------
TYPE_MODULE = "sv_module"
TYPE_FILE = "sv_file"
TYPE_SECTION = "md_section"

# ---- near-duplicate removal -------------------------------------------------
MIN_RECORD_CHARS = 50
SHINGLE_CHARS = 5
NUM_PERM = 128
# 8 bands of 16 rows minimise half false positives plus half false negatives at
# a similarity threshold of 0.85.
BANDS = 8
BAND_ROWS = 16

# ---- labels -----------------------------------------------------------------
UVM_MARKS = ("uvm_component", "uvm_sequence", "`uvm_")
ASSERTION_MARKS = ("assert property", "assume property")
REGISTER_MAP_MARKS = ("register map", "reg_map", "offset 0x")

# ---- raw-text corpus --------------------------------------------------------
CORPUS_MIN_CHARS = 30
DOC_BOUNDARY = "<|endofdoc|>"
DOC_SEPARATOR = "\n<|endofdoc|>\n"

# ---- instruction pairs ------------------------------------------------------
BUG_MIN_CHARS, BUG_MAX_CHARS = 40, 3000
GEN_MIN_CHARS, GEN_MAX_CHARS = 100, 2000  # both exclusive
GEN_DEFAULT_ROWS = 100
SEED = 42

BUG_EDITS = {
    "flip_comparison": {
        "pattern": r"==(?!=)",
        "replacement": "!=",
        "desc": "changed an equality comparison (==) to a not-equal comparison (!=)",
    },
    "off_by_one_increment": {
        "pattern": rf"\+{WS}*1'b1",
        "replacement": "+ 2'b10",
        "desc": "changed a +1 increment to +2, an off-by-one style bug",
    },
    "invert_reset_polarity": {
        "pattern": rf"if{WS}*\({WS}*!rst_n{WS}*\)",
        "replacement": "if (rst_n)",
        "desc": "inverted the reset condition polarity (active-low check became active-high)",
    },
}

TASK_BUG = "rtl_bug_finding"
TASK_EXPLAIN = "rtl_explanation"
TASK_ASSERT = "sva_assertion_generation"
VERIFY_TASKS = ("rtl_generation", "rtl_bug_fix", "rtl_completion", "rtl_bug_finding")
COMPILE_TASKS = ("sva_assertion_generation", "rtl_bug_finding")

BUG_INSTRUCTION = "Find and explain the bug in this SystemVerilog module."
BUG_ANSWER_HEAD = (
    "**Bug found:** this module was mechanically modified from a working "
    "reference by a single change: "
)
BUG_ANSWER_TAIL = (
    ".\n\n**Fix:** revert that specific change and re-simulate to confirm "
    "original behavior is restored."
)
EXPLAIN_INSTRUCTION = (
    "Explain the following real SystemVerilog module in detail. "
    "Describe its ports, functionality, and timing behavior."
)
EXPLAIN_PROMPT_HEAD = (
    "Explain the following real SystemVerilog module.\n\n"
    "Describe:\n- Purpose\n- Ports\n- Functionality\n- Timing behavior\n"
    "- Important design details\n\nSystemVerilog:\n\n```systemverilog\n"
)
EXPLAIN_PROMPT_TAIL = "\n```\n"

SOURCE_MECHANICAL = "mechanical_bug_injection"
SOURCE_SEED = "verified_hand_written_seed"
# Completions come from whatever model the user ran; the tag is a parameter.
SOURCE_GENERATED = "llm_augmented"

CODE_BLOCK = r"(?s)```(?:systemverilog)?\n(.*?)\n```"

LINT_NA = "not_applicable"
LINT_UNAVAILABLE = "verilator_unavailable"
LINT_PASS = "verified_pass"
LINT_FAIL = "verified_fail"

# ---- split ------------------------------------------------------------------
TRAIN_SHARE, VAL_SHARE = 0.8, 0.1
SPLITS = ("train", "val", "test")

# ---- preference pairs and training views ------------------------------------
ASSERTION = "assert property"
DISABLED_NOTE = "  (disabled - checks nothing)"
MIN_PREFERENCE_PAIRS = 4
HEAD_INSTRUCTION = "### Instruction:\n"
HEAD_INPUT = "\n\n### Input:\n"
HEAD_RESPONSE = "\n\n### Response:\n"
PROMPT_CODE = "\n\nCode:\n"

# ---- scoring ----------------------------------------------------------------
MIN_ELAPSED_S = 1e-6
REWARD_FULL, REWARD_COMPILES = 1.0, 0.3
