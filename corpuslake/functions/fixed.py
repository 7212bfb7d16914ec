"""Fixed values that must equal the reference behaviour for equal results.

Everything here is data, stated plainly in natural order.
"""

# --- fixed values: boilerplate markers (searched in list order, case-sensitive)
START_MARKERS = [
    "*** START OF THIS PROJECT GUTENBERG",
    "*** START OF THE PROJECT GUTENBERG",
    "*END*THE SMALL PRINT",
]
END_MARKERS = [
    "*** END OF THIS PROJECT GUTENBERG",
    "*** END OF THE PROJECT GUTENBERG",
    "End of the Project Gutenberg",
    "End of Project Gutenberg",
]

# --- fixed values: pre-tokenization split patterns (GPT-2 and GPT-4 style)
GPT2_SPLIT_PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
GPT4_SPLIT_PATTERN = r"""'(?i:[sdmt]|ll|ve|re)|[^\r\n\p{L}\p{N}]?+\p{L}+|\p{N}{1,3}| ?[^\s\p{L}\p{N}]++[\r\n]*|\s*[\r\n]|\s+(?!\S)|\s+"""

# --- fixed values: special tokens
ENDOFTEXT = "<|endoftext|>"
UNK = "<|unk|>"
GPT4_SPECIAL_TOKENS = {
    "<|endoftext|>": 100257,
    "<|fim_prefix|>": 100258,
    "<|fim_middle|>": 100259,
    "<|fim_suffix|>": 100260,
    "<|endofprompt|>": 100276,
}
PAD_ID = 50256          # GPT-2 end-of-text id, used as padding
IGNORE_INDEX = -100     # target value skipped by the loss

# --- fixed values: word-level tokenizer
WORD_DELIMS = ',.:;?_!"()\''          # single-character delimiters, plus "--" and whitespace
DECODE_PUNCT_V1 = ',.?!"()\''         # no space kept before these when decoding (V1)
DECODE_PUNCT_V2 = ',.:;?!"()\''       # V2 adds ':' and ';'

# --- fixed values: instruction prompt template
PROMPT_HEADER = ("Below is an instruction that describes a task. "
                 "Write a response that appropriately completes the request.")
INSTRUCTION_TAG = "\n\n### Instruction:\n"
INPUT_TAG = "\n\n### Input:\n"
RESPONSE_TAG = "\n\n### Response:\n"
RESPONSE_MARK = "### Response:"

# --- fixed values: char-level BPE space / newline glyphs
SPACE_GLYPH = "Ġ"   # 'Ġ'
NEWLINE_ID = 198
CR_ID = 201

# --- fixed values: whitespace as Python's str.isspace() defines it.
# Written as an explicit class so Java regex and RE2 agree with it.
WS_CHARS = (r"\x{9}-\x{d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
            r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}")
WS = "[" + WS_CHARS + "]"
# Word characters as Python's str \w: letters, numbers, underscore.
WORD_CHARS = r"\p{L}\p{N}_"

# --- fixed value: first line of tokenizer model files in text form.
MODEL_FILE_VERSION = "minbpe v1"
