"""cadastra.streaming"""
