"""pactmill: chat-format corpora, answer contract checks, run metrics and vector block quantization on Spark."""
