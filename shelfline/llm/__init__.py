"""Operators that prepare documents, pages and conversations for language-model training."""
