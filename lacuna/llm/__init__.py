"""Training-data operators: ten independent document, chat, vector and URL operators."""
