"""amity.functions"""
