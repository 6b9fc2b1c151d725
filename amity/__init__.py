"""amity: social-graph and ratings analytics as Spark DataFrame operators.

Public API (all lazy DataFrames, no Python UDFs):

sources   read_friends, parse_friend_lines, read_profiles, first_profile_per_user,
          read_business, read_reviews, write_text, write_ordered_text, to_text_lines, write_edge_table,
          save_co_partitioned
graph     clean_edges, friend_pairs, friendships, triangles, mutual_friends, mutual_friend_rows,
          mutual_friend_lists, mutual_friend_counts, top_mutual_pairs,
          top_mutual_pairs_named, mutual_friend_profiles, max_friend_age,
          oldest_friend_top; write_friend_index, read_friend_index (a stored graph for several questions)
ratings   ratings_by_address, top_rated_businesses, top_rated_businesses_sql
functions age_years, parse_dob, to_id
"""

from amity.functions.columns import age_years, parse_dob, to_id
from amity.operators.friend_index import FriendIndex, read_friend_index, write_friend_index
from amity.operators.graph import (clean_edges, friend_pairs, friendships, max_friend_age, mutual_friend_counts,
                                   mutual_friend_lists, mutual_friend_profiles, mutual_friend_rows,
                                   mutual_friends, oldest_friend_top, top_mutual_pairs,
                                   top_mutual_pairs_named, triangles)
from amity.operators.ratings import ratings_by_address, top_rated_businesses, top_rated_businesses_sql
from amity.sources.sinks import save_co_partitioned, to_text_lines, write_edge_table, write_ordered_text, write_text
from amity.sources.text import (first_profile_per_user, parse_friend_lines, read_business,
                                read_friends, read_profiles, read_reviews)

__all__ = [n for n in dir() if not n.startswith("_")]
