"""Operators for training-data pipelines over text, chats and embeddings. Nothing else in skyloom imports this."""
