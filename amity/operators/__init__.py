"""amity.operators"""
