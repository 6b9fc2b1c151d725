"""amity.streaming"""
