"""cadastra.plans"""
