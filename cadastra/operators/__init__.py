"""cadastra.operators"""
