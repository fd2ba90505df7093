"""billforge.streaming"""
