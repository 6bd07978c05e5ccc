"""Fixed values.

FIXED VALUES: everything in this module must equal the values of the task the
library reproduces, or results (texts, token counts, weights) differ. They are
stated plainly and in their natural order.
"""

# --- Bracket alphabet: 4 ordered pairs (opening, closing) ---
BRACKET_PAIRS = [("(", ")"), ("[", "]"), ("{", "}"), ("<", ">")]
OPENERS = "([{<"
CLOSERS = ")]}>"

# --- Generation ---
DEFAULT_N_TYPES = 6            # validated 1..8, silently capped by the 4 pairs
N_TYPES_MIN, N_TYPES_MAX = 1, 8
MAIN_N_TYPES = 4               # the generation job's own call
MAIN_TOTAL_LENGTH = 20
MAIN_FILL_LENGTH = 10
MAIN_NESTING_DEPTH = 3
MAX_ATTEMPTS = 1000
OPEN_PROBABILITY = 0.6
RANDOM_TOTAL_HALF_RANGE = (20, 30)   # total = 2 * uniform[20, 30] when total <= 0
FILL_LOW_FRACTION = 0.2
FILL_HIGH_FRACTION = 0.5
MAX_TASK_ID = 100000000
DEFAULT_ROWS = 60000

# --- Preparation / training ---
ANSWER_MARKER = "FINAL ANSWER: "
ANSWER_JOIN = "\n\nFINAL ANSWER: "     # reasoning + this + completion
IGNORE_INDEX = -100
MAX_LENGTH_TRAIN = 768
MAX_LENGTH_INFER = 2048
MAX_NEW_TOKENS = 512
ANSWER_LOSS_WEIGHT = 5.0
SHUFFLE_SEED = 42
EVAL_FRACTION = 0.04
LOSS_WEIGHT_FLOOR = 1e-8
TRAIN_BATCH = 48
EVAL_BATCH = 12
GRAD_ACCUM = 4
LOGGING_STEPS = 10
EVAL_STEPS = 100
SAVE_STEPS = 100
SAVE_TOTAL_LIMIT = 2

# --- Length audit ---
AUDIT_MAX_LINES = 5000
ADVICE_MARGIN = 64
P95_MIN_N = 20
P99_MIN_N = 100

# --- Characters removed by Python's str.strip() (str.isspace), in code-point order ---
PY_WHITESPACE = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
                 "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
                 "\u2028\u2029\u202f\u205f\u3000")

# --- Prompt templates (two versions: training and inference differ in wording) ---
TRAIN_PROMPT_HEAD = (
    "Complete the following Dyck language sequence by adding the minimal necessary closing brackets.\n"
    "\n"
    "Sequence: "
)
TRAIN_PROMPT_TAIL = (
    "\n"
    "\n"
    "Rules:\n"
    "- Add only the closing brackets needed to match all unmatched opening brackets\n"
    "- Do not add any extra bracket pairs beyond what is required\n"
    "\n"
    "Response format (use only this format; no extra prose, no Qwen/DeepSeek-style commentary):\n"
    "- Use \"# Thought N: ...\" for each character or step (e.g. opening → push, closing → pop, stack state).\n"
    "- Then \"# So we add closing brackets one by one in this order:\" and \"# Step k: add 'X'.\" for each closing bracket.\n"
    "- End with \"FINAL ANSWER: \" followed by the complete Dyck sequence only.\n"
    "Do not add conversational text, \"Wait...\", \"Let me recount\", or other base-model-style phrasing."
)
INFER_PROMPT_HEAD = TRAIN_PROMPT_HEAD
INFER_PROMPT_TAIL = (
    "\n"
    "\n"
    "Rules:\n"
    "- Add only the closing brackets needed to match all unmatched opening brackets\n"
    "- Do not add any extra bracket pairs beyond what is required\n"
    "\n"
    "Response format (dataset style only; do not use Qwen/DeepSeek-style prose):\n"
    "- Use \"# Thought N: ...\" for each step (e.g. opening → push closing onto stack, stack state).\n"
    "- Then \"# So we add closing brackets one by one in this order:\" and \"# Step k: add 'X'.\" for each closing bracket.\n"
    "- End with \"FINAL ANSWER: \" followed by the complete Dyck sequence only.\n"
    "Do not add phrases like \"Wait...\", \"Let me recount\", or other conversational commentary."
)
INFER_EXAMPLE_SEQUENCE = "<[<⟨{(<[(("

# --- Reasoning trace lines ({} = slots, in order of appearance) ---
TRACE_OPEN = "# Thought {step}: '{ch}' is opening → push closing '{closer}' onto stack. Stack: {stack}\n"
TRACE_MATCH = "# Thought {step}: '{ch}' is closing → matches stack top, pop. Stack: {stack}\n"
TRACE_MISMATCH = "# Thought {step}: '{ch}' closing → pop. Stack: {stack}\n"
TRACE_SUMMARY = "# Thought {step}: All input processed. Stack (closings to add, top first): {stack}\n"
TRACE_ORDER = "# So we add closing brackets one by one in this order:\n"
TRACE_STEP = "# Step {k}: add '{ch}'.\n"
TRACE_CLOSING = "# Closing sequence added: {closing}\n"
TRACE_COMPLETE = "# Complete Dyck sequence (prefix + closing): {full}\n"
TRACE_VERIFY = "Verification — full sequence: {full}\n"

# --- Response format rules stated in the prompts ---
RESPONSE_ORDER_LINE = "# So we add closing brackets one by one in this order:"
BANNED_PHRASES = ["Wait...", "Let me recount"]
