"""billforge.operators"""
