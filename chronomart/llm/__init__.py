"""Operators for preparing training data: texts, conversations, vectors. Nothing else imports this."""
