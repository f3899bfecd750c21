"""cadastra.functions"""
